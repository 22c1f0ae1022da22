"""Spelling variants, sentence pieces and periodic runs against brute force and the library."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from triprollup.llm import periodic, pieces, queries, spelling

SF_DIR = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def pairs(docs):
    return list(map(tuple, docs.select("doc_id", "text").collect()))


# Spelling variants


def spelled_by_hand(rows):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    n = {w: k for w, k in seen.items() if len(w) >= 5 and k >= 3}
    without, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            without[w[:i], w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for words in without.values():
        for w in words:
            near[w] |= words - {w}
    forms = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n[w], len(near[w]), n.get(forms[w])))
    return sorted(out)


def spelled(docs):
    return sorted(map(tuple, spelling.spelling_groups(docs).collect()))


def test_variants_of_whole_texts(spark):
    expected = spelled_by_hand(pairs(documents(spark)))
    assert len(expected) > 1000 and any(r[1] and r[2] != r[1] for r in expected)
    assert sorted(map(tuple, queries.op11_spelling_variants(spark, SF_DIR).collect())) == expected


@pytest.mark.parametrize("cell", [600, 40, 3])
def test_cells_are_cut_down_to_leaves(spark, monkeypatch, cell):
    """Small cells: deeper levels, and at last leaves that are joined."""
    rng = random.Random(cell)
    made = {"".join(rng.choices("abcdéÿ", k=rng.randint(5, 7))) for _ in range(700)}
    rows = [(None, " ".join(w for w in made for _ in range(rng.choice([3, 4, 9, 20]))))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    leaves = []
    join = spelling.near_of_leaves
    monkeypatch.setattr(spelling, "near_of_leaves", lambda r: leaves.append(1) or join(r))
    monkeypatch.setattr(spelling, "CELL", cell)
    assert spelled(docs) == spelled_by_hand(rows)
    assert bool(leaves) == (cell < 600)


def test_one_edit():
    edits = [("abcde", "abcd"), ("abcde", "xbcde"), ("abcde", "abcdee"), ("aaaaa", "aaaaaa")]
    assert all(spelling.one_edit(a, b) and spelling.one_edit(b, a) for a, b in edits)
    others = [("abcde", "abcde"), ("abcde", "abced"), ("abcde", "abc"), ("abcde", "xbcdx")]
    assert not any(spelling.one_edit(a, b) for a, b in others)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=7), max_size=60), st.integers(0, 12))
def test_near_in_cell(words, level):
    """One cell that holds everything below a level: all pairs that live there, each once."""
    words = sorted(words)
    group = np.arange(256) % spelling.GROUPS
    counts = spelling.vectors(words, group)
    cells = defaultdict(list)
    for row, vector in enumerate(counts[:, :level].tolist()):
        for to, state in spelling.reached(tuple(vector), spelling.LIVES):
            cells[to].append((row, state))
    found = []
    for members in cells.values():
        rows, states = map(np.array, zip(*members))
        met = spelling.near_in_cell([words[r] for r in rows], states, counts[rows][:, level:])
        found += [tuple(sorted((int(rows[a]), int(rows[b])))) for a, b in met]
    expected = [
        (i, j) for i in range(len(words)) for j in range(i) if spelling.one_edit(words[i], words[j])
    ]
    assert sorted(found) == sorted(tuple(sorted(p)) for p in expected)


def test_variants_of_odd_and_empty_tables(corpus, clashing, odd_rows):
    assert spelled(corpus([])) == []
    rows = [*odd_rows, *odd_rows, (9, "ÀÉÎÕÜ àéîõü ÀÉÎÕÜ" * 3), (10, "x" * 20_000), (11, None)]
    rows += [(20 + i, "x" * 19_999 + " " + "x" * 20_000) for i in range(9)]
    assert spelled(corpus(rows)) == spelled_by_hand(rows)
    assert spelled(clashing(rows)) == spelled_by_hand(rows)


# Sentence pieces


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=pieces.model_path())


TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "  a   b    ", "▁", "▁▁a▁", "a▁ ▁b", "\n", " \n \n",
    "a\r\n\tb  \t c", "<s> </s><unk> <0x0A>", "é ß 漢字🙂 ‍́  　x", "a\0b \0",
    "x" * 3000, "{ ▁{\r\n ▁\r", " " * 40 + "}" + " " * 17, "한국어 ⁇ � \U0010ffff", "1 23 456,7",
]


def by_library(model, rows):
    out = []
    for doc_id, text in rows:
        ids = model.encode(text or "")
        out.append((doc_id, ids, model.decode(ids)))
    return out


def test_pieces_of_whole_texts(spark, library):
    expected = {
        (
            doc_id,
            len(ids),
            hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )
        for doc_id, ids, text in by_library(library, pairs(documents(spark)))
    }
    found = queries.op12_sentence_pieces(spark, SF_DIR)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert set(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("kept", [300_000, 2])
def test_pieces_of_odd_texts(corpus, library, odd_rows, monkeypatch, kept):
    rows = [*odd_rows, *odd_rows[:3], *((100 + i, t) for i, t in enumerate(TEXTS))]
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", kept)
    table = pieces.ChunkTable(pieces.model_path())
    expected = by_library(library, rows)
    found = table.encode([t or "" for _, t in rows])
    ids = [np.frombuffer(f, "<i4") for f in found]
    assert [i.tolist() for i in ids] == [e[1] for e in expected]
    assert table.decode(ids) == [e[2] for e in expected]
    assert table.encode_and_decode([t or "" for _, t in rows]) == (found, [e[2] for e in expected])
    by_spark = map(tuple, pieces.tokenized(corpus(rows)).collect())
    assert sorted(by_spark, key=repr) == sorted(expected, key=repr)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("  ▁\n\r\t\0ab.{<s>/0é漢🙂́"), max_size=40))
def test_pieces_of_any_text(library, text):
    table = pieces.table_at(pieces.model_path())
    ids = np.frombuffer(table.encode([text])[0], "<i4")
    assert ids.tolist() == library.encode(text)
    assert table.decode([ids]) == [library.decode(ids.tolist())]
    assert table.encode_and_decode([text])[1] == [library.decode(ids.tolist())]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 31_999), max_size=30))
def test_any_ids_are_decoded(library, ids):
    assert pieces.table_at(pieces.model_path()).decode([np.array(ids, "<i4")]) == [library.decode(ids)]


def test_pieces_of_empty_and_clashing_tables(corpus, clashing, odd_rows):
    assert pieces.tokenized(corpus([])).collect() == []
    docs = clashing(odd_rows)
    found = pieces.encode_texts(docs, pieces.model_path())
    assert set(docs.columns) - {"text"} == set(found.columns) - {"ids"}
    assert {r["slot"] for r in found.collect()} == {"x"}
    again = pieces.decode_ids(found, pieces.model_path())
    texts = {(i, t or "") for i, t in pairs(docs)}
    assert set(pairs(again)) == texts


# Periodic runs


def runs_by_hand(words):
    """Each maximal stretch with a period, for all periods; multiples of a period go."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - start
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
            start = end + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def periodic_by_hand(rows, plant=True):
    out = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        h = zlib.crc32(str(doc_id).encode())
        if plant and doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = runs_by_hand(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out.append((
            doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        ))
    return out


def test_runs_of_whole_texts(spark):
    rows = [r for r in pairs(documents(spark))]
    found = list(map(tuple, queries.op13_periodic_runs(spark, SF_DIR).collect()))
    short = {i for i, t in rows if len((t or "").split()) <= 3000}
    expected = periodic_by_hand([r for r in rows if r[0] in short])
    assert len(found) == len(rows) and sum(r[1] > 0 for r in expected) > 10
    assert sorted(r for r in found if r[0] in short) == sorted(expected)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=40), max_size=6), st.integers(0, 3))
def test_runs_of_any_words(texts, tail):
    texts = [t + t[-3:] * 4 * tail for t in texts]
    bounds = np.cumsum([0, *map(len, texts)])
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    flat = np.array([ord(w) for t in texts for w in t], np.int64)
    found = periodic.maximal_runs(owner * 1000 + flat, bounds[owner + 1], 6, 4)
    expected = [
        (int(b) + s, length, q) for t, b in zip(texts, bounds) for s, length, q in runs_by_hand(t)
    ]
    assert list(zip(*map(np.ndarray.tolist, found))) == expected


def test_common_prefixes_of_suffixes():
    rng = random.Random(5)
    words = np.array([rng.randrange(3) for _ in range(300)] + [7] * 60)
    ends = np.full(360, 360)
    order, levels = periodic.suffix_order(words, ends)
    plain = words.tolist()
    assert order.tolist() == sorted(range(360), key=lambda i: plain[i:])
    shared = periodic.common_prefixes(order, levels)
    for k in range(1, 360):
        a, b = plain[order[k - 1] :], plain[order[k] :]
        assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_runs_of_odd_and_empty_tables(corpus, clashing, odd_rows):
    assert periodic.periodic_runs(corpus([])).collect() == []
    rows = [*odd_rows, *odd_rows[4:5], *((100 + i, "a b c " * 9 + "x " * i) for i in range(40))]
    rows += [(300, "w " * 20_000), (301, "p q r s t " * 3_000 + "p q")]
    small = [r for r in rows if len((r[1] or "").split()) < 20_000]
    for docs in (corpus(rows), clashing(rows)):
        found = periodic.periodic_runs(docs).collect()
        assert len(found) == len(rows)
        got = {(r["doc_id"], tuple(map(tuple, r["runs"])), r["text"]) for r in found}
        assert (300, ((0, 20_000, 1),), "w") in got
        assert (301, ((0, 15_002, 5),), "p q r s t") in got
        for doc_id, text in small:
            if len((text or "").split()) < 2_000:
                runs = tuple(runs_by_hand(re.findall(r"[^\x20\x09-\x0D]+", text or "")))
                assert (doc_id, runs) in {(i, r) for i, r, _ in got}
