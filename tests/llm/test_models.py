"""Sharding, packing, rules and models: brute force, round trips and held-out accuracy."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from triprollup.llm import (
    feistel,
    host_rules,
    language_id,
    lm_scoring,
    matrices,
    packing,
    recurrent,
)
from triprollup.llm.batches import hashes_of
from triprollup.llm.queries import QUERIES
from triprollup.llm.tokens import WordTokenizer, tokenizer_path

from .test_filters import classes_by_hand, cleaned_by_hand, leaks_by_hand

SF_DIR = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# Sharding


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1_000, 4_097])
def test_walk_is_a_permutation(spark, n):
    rows = spark.range(n).select("id", feistel.walk(F.col("id"), n).alias("at"))
    back = rows.withColumn("back", feistel.walk(F.col("at"), n, backwards=True)).collect()
    assert sorted(r["at"] for r in back) == list(range(n))
    assert all(r["back"] == r["id"] for r in back)


def test_shards(corpus, clashing, odd_rows):
    rows = odd_rows * 7
    found = feistel.shard_documents(clashing(rows)).collect()
    sizes = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found)
    data = [(i, (t or "").encode()) for i, t in rows]
    assert sizes == Counter((i, len(d) + 1, zlib.crc32(d)) for i, d in data)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) == set(range(16)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sorted(r["number"] for r in found) == list(range(len(rows)))
    assert feistel.shard_documents(corpus([])).count() == 0


def test_shards_can_be_computed_and_repeated(spark):
    docs = documents(spark)
    first = feistel.shard_documents(docs)
    again = feistel.shard_documents(docs.repartition(7))
    names = ["doc_id", "shard", "slot"]
    assert sorted(first.select(*names).collect()) == sorted(again.select(*names).collect())
    number = feistel.number_at(F.col("shard"), F.col("slot"), docs.count())
    assert first.filter(number != F.col("number")).isEmpty()


# Packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


TEXTS = [
    "", " ", "it's WE'LL 12 3x!?", "a<|endoftext|>b C", "İstanbul ΑΣ Σ é ́a", "a b c d\x1ce",
    "Ünïcode, words... (and) punctuation!!", "’s ' '' 'tis", "​ ZW​x", "word,", "word", "KK ǅ", "x<|B|>",
    "dogs'. 'yes', foo”. «ok». «x». so…) hey🙂! é, x́. ที่) है, 50€. soft\u00ad. Kİ. क़. ½. ²) Ⅷ, x'\".",
]


def test_ids_by_words(spark, tokenizer):
    import pyarrow as pa

    texts = TEXTS + [r["text"] for r in documents(spark).collect()]
    words = WordTokenizer(tokenizer_path())
    for _ in range(2):
        ids, bounds = words.encode(pa.array([*texts, None], pa.string()))
        parts = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert parts == [e.ids for e in tokenizer.encode_batch([*texts, ""], add_special_tokens=False)]


def check_packed(rows, given, tokenizer, capacity):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    expected = Counter()
    for doc_id, text in given:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            expected[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(r[n] for n in names) for r in rows) == expected
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("open_bins, tokens", [(512, packing.TASK_TOKENS), (4, 3_000)])
def test_packing(clashing, odd_rows, tokenizer, monkeypatch, open_bins, tokens):
    monkeypatch.setattr(packing, "TASK_TOKENS", tokens)
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(TEXTS * 5)]
    found = packing.pack_documents(clashing(rows), 256, open_bins).collect()
    check_packed(found, rows, tokenizer, 256)


def test_packing_fills_sequences(spark, corpus, tokenizer):
    docs = documents(spark)
    found = packing.pack_documents(docs).collect()
    bins = check_packed(found, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, 4096)
    total = sum(r["length"] for r in found)
    assert bins <= 1.03 * math.ceil(total / 4096)
    assert packing.pack_documents(corpus([])).count() == 0


def test_the_fullest_bin_closes_first():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(5) == (1, 0)
    assert bins.place(4) == (0, 6)  # the best fit, now full
    assert bins.place(8) == (2, 0)
    assert bins.place(6) == (3, 0)  # closes 2, with 2 left, and not 1, with 5
    assert bins.place(5) == (1, 5) and bins.still_open() == {3}


def test_matrices_round_trip(spark, clashing, corpus, odd_rows, tokenizer):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(TEXTS)]
    packed = matrices.pack_matrices(clashing(rows), 128, cell_tokens=2_000)
    expected = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 128)):
            expected[doc_id, piece, start, tuple(ids[start : start + 128])] += 1
    back = matrices.unpacked(packed).collect()
    ids = lambda r: tuple(np.frombuffer(r["ids"], "<u2").tolist())
    assert Counter((r["doc_id"], r["piece"], r["start"], ids(r)) for r in back) == expected
    sequences = packed.collect()
    assert len({r["sequence_id"] for r in sequences}) == len(sequences)
    for r in sequences:
        ends, at = r["cu_seqlens"], np.frombuffer(r["positions"], "<u2")
        assert len(r["ids"]) == len(r["positions"]) == 256
        assert ends[0] == 0 and ends[-1] == r["n_tokens"] and len(ends) == r["n_segments"] + 1
        for a, b in zip(ends, ends[1:]):
            assert at[a:b].tolist() == list(range(b - a))
        assert not any(np.frombuffer(r["ids"], "<u2")[ends[-1] :])
    assert matrices.pack_matrices(corpus([])).count() == 0


def test_written_matrices(spark, corpus, tmp_path):
    docs = corpus([(1, "one two"), (2, "three")], parts=1)
    read = matrices.write_matrices(docs, str(tmp_path / "packed"))
    assert read.count() == 1 and read.first()["n_segments"] == 2


def test_best_fit_decreasing():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 101, size=400).tolist()
    rows = matrices.best_fit_decreasing(lengths, 100)
    assert sorted(i for row in rows for i in row) == list(range(400))
    assert all(sum(lengths[i] for i in row) <= 100 for row in rows)
    free: list[int] = []
    for length in sorted(lengths, reverse=True):  # the same by a plain search
        fits = [f for f in free if f >= length]
        left = min(fits) if fits else 100
        if fits:
            free.remove(left)
        free.append(left - length)
    assert len(free) == len(rows)


# Host rules


def measured_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def test_measures(spark, clashing, odd_rows):
    rows = [*odd_rows, (50, "a b c d e f a b c d e x a b c d e"), (51, "x\nx\n \n \ny #*<")]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for docs in (clashing(rows), documents(spark)):
        given = Counter((r["doc_id"], *measured_by_hand(r["text"])) for r in docs.collect())
        found = host_rules.judged(docs).select("doc_id", *names).collect()
        assert Counter(map(tuple, found)) == given


def test_hosts(corpus, prose):
    good, bad = prose(60, 1), "few words"
    rows = [(i, good if i % 5 else bad, "en", f"good{i % 10}") for i in range(500)]
    rows += [(1_000 + i, bad if i % 10 else good, "en", "bad") for i in range(100)]
    rows += [(2_000, bad, "en", "new"), (2_001, good, "en", "new"), (3_000, good, "en", None)]
    found = {r["doc_id"]: r["kept"] for r in host_rules.judged(corpus(rows)).collect()}
    for doc_id, text, _, source in rows:
        assert found[doc_id] == (text == good and source != "bad"), (doc_id, source)
    verdicts = host_rules.host_verdicts(host_rules.measures(corpus(rows))).collect()
    rates = {r["source"]: r["shrunk_rate"] for r in verdicts}
    assert rates["new"] < 0.5 < rates["bad"] < 0.9
    assert host_rules.judged(corpus([])).count() == 0
    alone = host_rules.judged(corpus([(1, good), (2, bad)])).collect()
    assert {r["doc_id"]: r["kept"] for r in alone} == {1: True, 2: False}


# Language


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(docs, language_id.fit(docs)).withColumn("h", language_id.held_out())
    rows = found.collect()
    held = [r for r in rows if r["h"]]
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(spark, clashing, corpus, odd_rows):
    model = language_id.train([b"aaa bbb " * 20, b"xxx yyy " * 20], ["p", "q"])
    docs = clashing([*odd_rows, (60, "xxx yyy " * 9), (61, "12 !!"), (62, "aaa bbb " * 9)])
    found = language_id.identify(docs, model)
    by_id = {r["doc_id"]: r["lang_pred"] for r in found.collect()}
    assert set(found.columns) == set(docs.columns)
    assert [by_id[i] for i in (1, 2, 3, 60, 61, 62)] == ["und"] * 3 + ["q", "und", "p"]
    assert language_id.fit(corpus([(1, "text", None)])) is None
    untaught = language_id.identify(corpus([(1, "text")]), None).first()
    assert (untaught["lang_pred"], untaught["score"]) == ("und", 0.0)
    assert language_id.identify(corpus([]), model).count() == 0


def test_every_label_is_learned(corpus):
    """Two hundred labels; some have a single text."""
    rng = np.random.default_rng(4)
    names, rows = [f"l{i:03d}" for i in range(200)], []
    for i, name in enumerate(names):
        a, b = divmod(i, 14)
        word = chr(97 + a) * 3 + chr(110 + b if b < 13 else 65) * 3 + " "
        ids = [d for d in range(1_000 * i, 1_000 * i + 40) if zlib.crc32(str(d).encode()) % 4 != 2]
        rows += [(d, word * int(rng.integers(20, 40)), name) for d in ids[: 1 if i % 50 == 7 else 12]]
    sample = language_id.labelled_sample(corpus(rows)).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in sample} == Counter(r[2] for r in rows)
    few = language_id.labelled_sample(corpus(rows), 3).groupBy("lang").count().collect()
    assert len(few) == 200 and {r["count"] for r in few} == {1, 3}
    model = language_id.fit(corpus(rows), hidden=16, steps=700)
    assert model.languages == names
    found = language_id.identify(corpus(rows), model).select("lang", "lang_pred").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.9
    assert len({r["lang_pred"] for r in found}) > 180


@pytest.mark.parametrize("languages", [1, 2, 10])
def test_doubt_does_not_depend_on_the_number_of_languages(spark, corpus, languages):
    """Clean documents stay whatever the number of languages; noise and letterless texts go."""
    rng = np.random.default_rng(languages)
    alphabets = ["abcdef", "ghijkl", "mnopqr", "stuvwx", "ABCDEF", "GHIJKL", "MNOPQR", "STUVWX", "αβγδεζ", "абвгде"]

    def text(letters):
        return " ".join("".join(rng.choice(list(letters), 5)) for _ in range(60))

    rows = [(100 * i + k, text(alphabets[i]), f"l{i}") for i in range(languages) for k in range(40)]
    junk = [(5_000, "12 !! 34", "l0"), (5_001, None, "l0"), (5_002, "", None)]
    kept = corpus_pipeline.known_language(spark, corpus([*rows, *junk]), "")
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows}
    assert 1 / languages <= language_id.least_score(languages) <= 1
    assert language_id.least_score(4) == pytest.approx(0.35)


def test_languages_by_a_plain_loop(corpus, prose):
    """Every byte of whole texts, one at a time, against the pooled prediction."""
    model = language_id.train([b"abc abd " * 30, b"xyz xxy " * 30, "éàü éü ".encode() * 30], ["p", "q", "r"])
    rows = [(1, "abc xyz"), (2, prose(90, 3)), (3, "é" * 200), (4, "xyz " * 99), (5, "a")]
    found = {r["doc_id"]: r for r in language_id.identify(corpus(rows), model).collect()}

    def states(direction, window):
        size = direction.turn.shape[0]
        h, out = np.zeros(size), []
        for byte in window:
            a = np.tanh(direction.rows[byte].astype(float) + h @ direction.turn)
            z = (a[:size] + 1) / 2
            h = h + z * (a[size:] - h)
            out.append(h @ direction.out)
        return np.array(out)

    width = language_id.WINDOW
    for doc_id, text in rows:
        data, logs, probs = text.encode(), np.zeros(3), np.zeros(3)
        for first in range(0, len(data), width):
            own = data[first : first + width]
            window = [own[i % len(own)] for i in range(width)]
            back = states(model.back, window[::-1])[::-1]
            scores = states(model.ahead, window) + back + model.bias
            each = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
            logs += each[: len(own)].sum(axis=0)
            probs += np.exp(each[: len(own)]).sum(axis=0)
        best = int(logs.argmax())
        assert found[doc_id]["lang_pred"] == model.languages[best]
        assert found[doc_id]["score"] == pytest.approx(probs[best] / len(data), abs=1e-4)


def test_tagger_gradients():
    rng = np.random.default_rng(0)
    d = language_id.Direction(
        *(rng.standard_normal(s) * 0.3 for s in ((256, 6), (3, 6), (3, 2)))
    )
    text, aim = rng.integers(256, size=(5, 4)), rng.standard_normal((5, 4, 2))

    def loss():
        return float((d.forward(text) * aim).sum())

    logits, trace, last = d.forward(text, keep=True)
    gradients = d.backward(text, trace, last, aim)
    for weight, gradient, at in zip((d.rows, d.turn, d.out), gradients, ((text[1, 2], 1), (1, 4), (2, 1))):
        weight[at] += 1e-3
        up = loss()
        weight[at] -= 2e-3
        assert gradient[at] == pytest.approx((up - loss()) / 2e-3, rel=0.02, abs=2e-3)
        weight[at] += 1e-3


# Language model


def base_by_hand(rows):
    split = lambda t: (t or "").encode().lower().split()
    learned = [split(t) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for words in learned for w in words)
    ends = len(learned)
    total, types = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for i, t in rows:
        words = split(t)
        each = [*(counts[w] for w in words), ends]
        base = sum(math.log10((c + 1) / (total + types + 1)) for c in each)
        out.append((i, len(words) + 1, sum(c > 0 for c in each), total, pytest.approx(base)))
    return out


def test_scores(spark, clashing, odd_rows):
    for docs in (clashing(odd_rows), documents(spark)):
        names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score"]
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        found = lm_scoring.score_documents(docs)
        order = lambda r: (r[0] is None, r[0] or 0, r[1])
        given = sorted(map(tuple, found.select(*names).collect()), key=order)
        assert given == sorted(base_by_hand(rows), key=order)
        assert all(r["score"] < 0 for r in found.collect())


def test_the_model_beats_the_base_and_an_untrained_one(spark, monkeypatch):
    """Most of the gain on the base is the allowance for unknown words: learning must add to it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")

    def held_out():
        found = lm_scoring.score_documents(docs).filter("held_out")
        return found.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()

    trained, base, n = held_out()
    fit = lm_scoring.fit

    def without_state(*args):
        """The update gate is open and nothing is carried over: a state tells the last word only."""
        model = fit(*args)
        model.rows[:, : model.hidden], model.gates[:], model.candidate[:] = 20, 0, 0
        return model

    with monkeypatch.context() as patch:
        patch.setattr(lm_scoring, "fit", without_state)
        stateless = held_out()[0]
    monkeypatch.setattr(
        lm_scoring, "fit", lambda _, v, __: recurrent.started(v.frequencies(), v.side, v.side)
    )
    untrained = held_out()[0]
    assert trained > base + 0.1 * n and trained > untrained + 0.1 * n
    assert trained > stateless + 0.02 * n


def test_scores_by_a_plain_loop(corpus, prose, monkeypatch):
    """The model's arithmetic, one word at a time, against the scores of whole documents."""
    kept = []
    fit = lm_scoring.fit

    def watched(coded, vocabulary, rounds):
        kept[:] = [vocabulary, fit(coded, vocabulary, rounds)]
        return kept[1]

    monkeypatch.setattr(lm_scoring, "fit", watched)
    rows = [(i, prose(60, i % 7, "abcd")) for i in range(40)] + [(99, None), (100, "unknown éé")]
    found = {r["doc_id"]: r["score"] for r in lm_scoring.score_documents(corpus(rows)).collect()}
    vocabulary, model = kept
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i, _ in rows}
    counts = Counter(w for i, t in rows if fold[i] != 2 for w in (t or "").split())
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    size = model.hidden
    for doc_id, text in rows:
        words = (text or "").split()
        hashes = hashes_of([w.encode() for w in words])
        types, share = vocabulary.types_of(hashes, np.array([counts[w] for w in words], int))
        total, h, fed = float(np.sum(share)), np.zeros(size), recurrent.END
        for aim in [*types.tolist(), recurrent.END]:
            into = model.rows[fed].astype(float)
            z, r = np.split(sigmoid(into[: 2 * size] + h @ model.gates), 2)
            c = np.tanh(into[2 * size :] + (r * h) @ model.candidate)
            h = (1 - z) * h + z * c
            logits = h @ model.classes + model.class_bias
            k = int(model.class_of(np.array([aim]))[0])
            total += logits[k] - np.log(np.exp(logits).sum())
            if k < model.heads:
                inside = model.within[k] @ h + model.within_bias[k]
                total += inside[aim - k * model.members] - np.log(np.exp(inside).sum())
            fed = aim
        assert found[doc_id] == pytest.approx(total / np.log(10), rel=1e-4)


def test_shares_do_not_depend_on_partitions(spark, corpus, prose, monkeypatch):
    """Each share is learned apart, however many of them one task gets."""
    monkeypatch.setattr(lm_scoring, "FIRST_TOKENS", 500)
    monkeypatch.setattr(lm_scoring, "TASK_TOKENS", 200)
    keys = lm_scoring.dealt_keys(spark, 13)
    at = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k bigint").selectExpr("pmod(hash(k), 13)").collect()]
    assert at == list(range(13))
    docs = corpus([(i, prose(30, i, "abc")) for i in range(120)])
    scores = []
    for most in (lm_scoring.DEALT_SHARES, 0):
        monkeypatch.setattr(lm_scoring, "DEALT_SHARES", most)
        found = lm_scoring.score_documents(docs).select("doc_id", "score").collect()
        scores.append([s for _, s in sorted(map(tuple, found))])
    assert scores[0] == pytest.approx(scores[1], rel=1e-4)


def test_the_model_learns_whole_documents(corpus, prose):
    late = [(i, f"{prose(1_600, i)} {'left right ' * 400}") for i in range(20)]
    found = lm_scoring.score_documents(corpus([*late, (None, "left right " * 200)]))
    told = found.filter("doc_id is null").first()
    assert told["score"] / told["n_tokens"] > -0.5


def test_every_document_is_in_one_round_and_every_token_a_target(monkeypatch, corpus):
    for tokens in (0, 10, 10**6, 10**8, 10**10):
        rounds = lm_scoring.rounds_of(tokens)
        assert [0.0, *(last for _, last in rounds)] == [*(first for first, _ in rounds), 1.0]
    parts = [np.append(np.full(n, n + 1), recurrent.END) for n in range(700)]
    fed, aims = (x.T.ravel().tolist() for x in recurrent.in_streams(parts, 24))
    tokens = np.concatenate(parts).tolist()
    assert aims[: len(tokens)] == tokens and fed[: len(tokens)] == [recurrent.END, *tokens[:-1]]
    taught = []  # by tasks, in several rounds
    monkeypatch.setattr(lm_scoring, "FIRST_TOKENS", 100)
    monkeypatch.setattr(lm_scoring, "TASK_TOKENS", 20)
    real = lm_scoring.learned_in

    def learned_in(documents, *more):
        taught.extend(len(r["types"]) // 2 for r in documents.collect())
        return real(documents, *more)

    monkeypatch.setattr(lm_scoring, "learned_in", learned_in)
    rows = lm_scoring.score_documents(corpus([(i, "word " * (i % 9)) for i in range(200)])).collect()
    assert sorted(taught) == sorted(r["n_tokens"] for r in rows if not r["held_out"])


def test_scores_without_training_documents(corpus):
    assert lm_scoring.score_documents(corpus([])).count() == 0
    alone = lm_scoring.score_documents(corpus([(None, "some words")])).first()
    assert (alone["n_tokens"], alone["n_known"], alone["train_tokens"]) == (3, 0, 0)


def test_texts_are_split_once(spark, corpus, prose, monkeypatch):
    """Splitting cost as much as scoring: later steps go by the numbers of words."""
    texts, real = spark.sparkContext.accumulator(0), lm_scoring.split

    def counted(column):
        texts.add(len(column))
        return real(column)

    monkeypatch.setattr(lm_scoring, "split", counted)
    docs = corpus([(i, prose(30, i)) for i in range(50)])
    assert len(lm_scoring.score_documents(docs).collect()) == 50
    assert texts.value == 50


def test_a_block_tells_each_word_once(spark, corpus, monkeypatch):
    """Though its rows come in several batches, and a text that is too long is alone."""
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 100)
    rows = [(1, "b a B"), (2, None), (3, "a c"), (8, "c " * 99), (4, "a\u00e9"), (None, " d  a ")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        found = lm_scoring.blocks(lm_scoring.placed(corpus(rows).coalesce(1))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    words = [(r["block"], r["word"]) for r in found if r["numbers"] is None]
    assert len(set(words)) == len(words)
    texts = dict(rows)
    by_hash = dict(zip(hashes_of([w.encode() for w in "a b c d aé".split()]).tolist(), "a b c d aé".split()))
    told = [r for r in found if r["numbers"] is not None]
    assert len(told) == len(rows)
    for r in told:
        own = sorted(w for b, w in words if b == r["block"])
        numbers = lm_scoring.unpacked(r["numbers"], lm_scoring.bytes_of(len(own)))
        assert [by_hash[own[k]] for k in numbers] == (texts[r["doc_id"]] or "").lower().split()
    (alone,) = {r["block"] for r in told if r["doc_id"] == 8}
    assert sum(r["block"] == alone for r in told) == 1


def test_numbers_in_few_bytes():
    for most in (1, 2, 256, 257, 65_536, 65_537, 2**24 + 1):
        width, numbers = lm_scoring.bytes_of(most), np.array([0, most - 1, most // 2])
        assert 256 ** (width - 1) < most <= 256**width or most == width == 1
        data = lm_scoring.packed(numbers, width).tobytes()
        assert lm_scoring.unpacked(data, width).tolist() == numbers.tolist()
    assert len(lm_scoring.unpacked(b"", 1)) == 0


def test_rows_of_a_type_are_added():
    rng = np.random.default_rng(5)
    for most, n in ((1, 700), (40, 700), (5000, 700), (3, 1)):
        types, values = rng.integers(most, size=n), rng.standard_normal((n, 3)).astype(np.float32)
        whole = np.zeros((most, 3))
        np.add.at(whole, types, values)
        found, sums = recurrent._row_sums(values, types)
        assert found.tolist() == sorted(set(types.tolist()))
        assert np.allclose(sums, whole[found], atol=1e-4)


def test_weights_too_large_for_exp():
    """Beyond SAFE logits are shifted; without that their exps are infinite."""
    model = recurrent.GatedLM.new(3, 4, 2, 6, np.random.default_rng(3))
    model.classes *= 3000
    model.within *= 3000
    states = np.random.default_rng(4).uniform(-1, 1, (9, 6)).astype(np.float32)
    aims = np.arange(9)
    found = model.log_probs(states, aims)
    for i, t in enumerate(aims):
        logits = states[i].astype(float) @ model.classes
        inside = model.within[t // 4].astype(float) @ states[i]
        by_hand = logits[t // 4] - np.logaddexp.reduce(logits) + inside[t % 4] - np.logaddexp.reduce(inside)
        assert found[i] == pytest.approx(by_hand, rel=1e-4, abs=1e-3)
    fed = np.zeros((3, 3), int)
    (_, g_rows), gradients, _ = model.learn(fed, aims.reshape(3, 3), np.zeros((3, 6), np.float32))
    assert all(np.isfinite(g).all() for g in (g_rows, *gradients))


def test_model_is_a_distribution_and_carries_state():
    rng = np.random.default_rng(1)
    model = recurrent.GatedLM.new(3, 4, 2, 6, rng)
    states = rng.standard_normal((1, 6)).astype(np.float32)
    logs = [model.log_probs(states, np.array([t]))[0] for t in range(14)]
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)
    text = [np.append(rng.integers(1, 14, size=n), recurrent.END) for n in (50, 1, 7)]
    assert model.score(text, window=4) == pytest.approx(model.score(text, window=64), rel=1e-5)
    assert model.score(text, width=1) == pytest.approx(model.score(text), rel=1e-5)


def test_model_gradients():
    rng = np.random.default_rng(2)
    model = recurrent.GatedLM.new(2, 3, 2, 4, rng)
    for name in ("rows", "gates", "candidate", "classes", "class_bias", "within", "within_bias"):
        setattr(model, name, getattr(model, name).astype(float))
    fed, aim = rng.integers(8, size=(2, 6, 5))

    def loss():
        h, total = np.zeros((5, 4)), 0.0
        for t in range(6):
            h = h * (fed[t] != recurrent.END)[:, None]
            h = model.step(fed[t], h, np.empty((5, 8)), np.empty((5, 4)))
            total -= model.log_probs(h, aim[t]).sum()
        return total / 30

    (rows, g_rows), others, _ = model.learn(fed, aim, np.zeros((5, 4)))
    whole = np.zeros_like(model.rows)
    whole[rows] = g_rows
    for weight, gradient in zip(model.weights(), [whole, *others]):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        weight[at] += 1e-3
        up = loss()
        weight[at] -= 2e-3
        down = loss()
        weight[at] += 1e-3
        assert gradient[at] == pytest.approx((up - down) / 2e-3, rel=0.02, abs=1e-4)


# Queries and pipeline


def test_every_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))


def test_pipeline_stages(spark, clashing, odd_rows, prose):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    rows = [*odd_rows, (70, f"{prose(30, 1)} {item}"), (71, prose(100, 2)), (72, prose(100, 2) + " x")]
    docs = clashing([(i, t, ["en", "fr"][n % 2]) for n, (i, t) in enumerate(rows)])
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns, name
        kept.append({r["doc_id"] for r in docs.collect()})
    assert not kept[0] & {1, 2, 3} and 72 in kept[1] - kept[2] and 70 in kept[2] - kept[3]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r["doc_id"] for r in last.collect()} == kept[-1]


def test_language_stage_without_labels(spark, corpus):
    docs = corpus([(1, "some words", None), (2, "漢字", None), (3, "12 !", None), (4, None, None)])
    assert {r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, SF_DIR).collect()} == {1, 2}


def pipeline_by_hand(rows, items, model):
    """The documents that the first four stages leave, by plain code."""
    kept = [
        (doc_id, text)
        for doc_id, text in rows
        if any(c.isalpha() for c in text or "") and model.predict([text.encode()])[0][1] >= model.least
    ]
    kept = [(doc_id, text) for doc_id, _, _, text in cleaned_by_hand(kept)]
    first = {r[0] for r in classes_by_hand(kept) if r[0] == r[1]}
    kept = [r for r in kept if r[0] in first]
    leaked = {doc_id for doc_id, _ in leaks_by_hand(kept, items)}
    return [r for r in kept if r[0] not in leaked]


def test_pipeline_by_hand(spark, tokenizer):
    """All five stages over the smallest tables, by document and piece."""
    docs, items = documents(spark), spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in items.collect()]
    expected = pipeline_by_hand(rows, items, language_id.fit(docs))
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    check_packed(found, expected, tokenizer, packing.CAPACITY)
    # Every stage has something to do.
    assert len(rows) > len(expected) > len(rows) // 2
    assert any(dict(rows)[doc_id] != text for doc_id, text in expected)


@pytest.mark.parametrize("filled", ["documents", "benchmark", None])
def test_pipeline_of_empty_tables(spark, corpus, prose, tmp_path, filled):
    rows = [(i, prose(30, i), "en") for i in range(9)] if filled == "documents" else []
    items = [(1, prose(12, 3))] if filled == "benchmark" else []
    corpus(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} == {r[0] for r in rows}
