"""The extreme-value law of toxic segments takes every token of the clean texts."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from articleflow.llm import toxicity  # noqa: E402


def test_rate_from_long_texts_with_many_hits(spark):
    rng = random.Random(6)
    plain = [" ".join(f"w{rng.randrange(50)}" for _ in range(1500)) for _ in range(60)]
    texts = [t + " zork" for t in plain[:30]] + plain[30:59] + [plain[59] + " zork" * 600]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scores = toxicity.Scores(model.lexicon)
    clean = [scores[w] for t in texts[30:] for w in toxicity.words_of(t.encode())]
    assert sum(s > 0 for s in clean) >= 600
    mean = np.mean([np.exp(model.rate * (s if s > 0 else -model.gap)) for s in clean])
    assert model.rate > 0.05 and mean == pytest.approx(1, abs=1e-6)
