"""Files that tasks write to the shared folder beside Spark's own tables."""

from __future__ import annotations

import uuid

from pyarrow import fs


class Output:
    """A file that takes its name when closed without error."""

    def __init__(self, path: str):
        self.fs, self.place = fs.FileSystem.from_uri(path)
        self.fs.create_dir(self.place.rsplit("/", 1)[0], recursive=True)
        self.part = f"{self.place}.{uuid.uuid4().hex[:8]}.part"
        self.out = self.fs.open_output_stream(self.part)

    def __enter__(self) -> Output:
        return self

    def write(self, content: bytes) -> None:
        self.out.write(content)

    def __exit__(self, kind, *_) -> None:
        self.out.close()
        if kind is None:
            # A task that ran before may have left the same file; not every store moves over one.
            if self.fs.get_file_info(self.place).type != fs.FileType.NotFound:
                self.fs.delete_file(self.place)
            self.fs.move(self.part, self.place)
        else:
            self.fs.delete_file(self.part)
