import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def corpus(spark):
    """documents from (doc_id, text) pairs, or with lang and source, in several partitions."""

    def build(rows, parts=3, schema=SCHEMA):
        full = []
        for doc_id, text, *more in rows:
            lang, source = (*more, *("en", "host")[len(more) :])
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, schema).repartition(parts)

    return build


@pytest.fixture
def prose():
    """A text of invented words, the same for the same seed."""

    def build(words, seed, letters="aeinorst"):
        rng = random.Random(seed)
        made = ("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(words))
        return " ".join(made)

    return build


@pytest.fixture
def odd_rows(prose):
    """Null ids and texts, empty and very long texts, ties and repeated rows."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t\n"),
        (None, "no id at all here, but some words to read"),
        (4, prose(30_000, 4)),
        (5, "the same text in two rows, more than five words"),
        (5, "the same text in two rows, more than five words"),
        (6, "the same text in two rows, more than five words"),
        (7, "é ß 漢字 🙂\r\nline\x0btwo"),
        (8, "a" * 3_000),
    ]


@pytest.fixture
def clashing(corpus):
    """Documents with further columns, named like those that operators add."""

    def build(rows):
        extra = ["number", "slot", "shard", "row", "lost", "spans", "set", "start", "lang_pred",
                 "score", "n_lines", "n_dropped", "data", "removed", "window", "key", "block"]
        docs = corpus(rows)
        for name in extra:
            docs = docs.selectExpr("*", f"'x' as `{name}`")
        return docs

    return build
