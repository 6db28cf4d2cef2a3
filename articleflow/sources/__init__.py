"""Readers, writers and the rule tables that describe sources."""
