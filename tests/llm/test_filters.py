"""Line dedup, decontamination, near-duplicates and repeated strings against brute force."""

import hashlib
import random
import string
from collections import Counter, defaultdict

import numpy as np
import pytest

from triprollup.llm import decontaminate, jaccard_forest, line_dedup, suffix_dedup
from triprollup.llm.components import connected
from triprollup.llm.cuckoo import CuckooFilter

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SF_DIR = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# Line dedup


def cleaned_by_hand(rows):
    held = defaultdict(set)
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in (t or "").split("\n")]
    for doc_id, text in rows:
        for key in keys(text):
            if doc_id is not None and len(key) >= 20:
                held[key].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [
            doc_id is not None and len(held[k]) >= 3 and max(held[k]) != doc_id for k in keys(text)
        ]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((doc_id, len(lines), sum(gone), kept))
    return sorted(out, key=repr)


def cleaned(docs):
    found = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "text")
    return sorted(map(tuple, found.collect()), key=repr)


def test_lines(spark, corpus, odd_rows):
    line, other = "A line held by many documents ", "  é line of twenty code p"
    rows = [(100 + i, f"{line}\n{i}\n{line.lower()}\nshort") for i in range(5)]
    rows += [(200 + i, f"{other}\n{other}") for i in range(2)]
    rows += [*odd_rows, *odd_rows[:2]]
    assert cleaned(corpus(rows)) == cleaned_by_hand(rows)
    whole = documents(spark).select("doc_id", "text")
    assert cleaned(whole) == cleaned_by_hand(list(map(tuple, whole.collect())))


def test_a_line_of_twenty_code_points_counts(corpus):
    rows = [(i, x) for x in ("é" * 19, "é" * 20) for i in range(3)]
    assert sum(r[2] for r in cleaned(corpus(rows))) == 2


def test_deletion_undoes_insertion(spark):
    docs = documents(spark)
    some, others = docs.filter("doc_id % 3 = 0"), docs.filter("doc_id % 3 <> 0")
    before = line_dedup.LineStore.empty(spark).insert(some)
    after = before.insert(others).delete(others.select("doc_id"))
    assert sorted(before.dropped().collect()) == sorted(after.dropped().collect())
    held = [r["held"] for r in after.filters.collect()]
    assert sum(held) == before.counts.count()


def test_hot_shards_are_dealt_in_cells(corpus, monkeypatch):
    rows = [(i, "one line that every document holds\nand another one for all of them") for i in range(300)]
    monkeypatch.setattr(line_dedup, "CELL_REFS", 20)
    assert sum(r[2] for r in cleaned(corpus(rows))) == 2 * 299


def test_lines_of_empty_and_clashing_tables(corpus, clashing, odd_rows):
    assert cleaned(corpus([])) == []
    docs = clashing(odd_rows)
    found = line_dedup.dedup_lines(docs)
    assert set(docs.columns) == set(found.columns) and found.count() == len(odd_rows)
    assert {r["slot"] for r in found.collect()} == {"x"}


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    keys, others = rng.integers(-(1 << 63), 1 << 63, size=(2, 50_000), dtype=np.int64)
    held = CuckooFilter.for_keys(len(keys))
    assert held.insert(keys) and held.contains(keys).all()
    assert held.contains(others).mean() < 0.001
    held.remove(keys[:30_000])
    again = CuckooFilter(table=held.to_bytes())
    assert again.contains(keys[30_000:]).all() and again.contains(keys[:30_000]).mean() < 0.001
    again.remove(keys[30_000:])
    assert not again.table.any()
    with pytest.raises(ValueError):
        again.remove(keys[:1])
    small = CuckooFilter(2)
    assert not small.insert(keys[:100])
    copies = CuckooFilter(64)
    assert copies.insert(np.repeat(keys[:1], 8)) and not copies.insert(keys[:1])


# Decontamination


def leaks_by_hand(rows, items):
    split = lambda t: (t or "").lower().split()
    found = {}
    for doc_id, text in rows:
        words = split(text)
        shingles = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        for item_id, item in items:
            own = split(item)
            ref = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
            if not ref or not set(shingles) & set(ref):
                continue
            for start in range(max(1, len(words) - len(own) + 1)):
                window = Counter(shingles[start : start + len(own) - 4])
                similar = sum((window & ref).values()) / sum((window | ref).values())
                key = (doc_id, item_id)
                if similar >= 0.8 and similar > found.get(key, 0):
                    found[key] = similar
    return found


def leaks(docs, items):
    found = decontaminate.contaminated(docs, items).collect()
    assert len({(r["doc_id"], r["item_id"]) for r in found}) == len(found)
    return {(r["doc_id"], r["item_id"]): pytest.approx(r["similarity"]) for r in found}


def test_leaks(spark, corpus, prose, odd_rows):
    item, long = prose(40, 1), prose(60, 2)
    words = long.split()
    near = " ".join([*words[:58], "changed", "ending"])
    broken = " ".join(words[:20] + ["other"] + words[21:40] + ["words"] + words[41:])
    items = [(1, item), (2, long), (3, "too short"), (4, None), (5, "the the the the the the the")]
    rows = [
        *odd_rows,
        (20, f"{prose(50, 3)} {item.upper()} {prose(50, 5)}"),
        (21, near),
        (22, f"{prose(9, 7)} {broken}"),
        (23, " ".join(words[3:])),
        (24, "the " * 50),
        (25, f"{item} {item} {long}"),
    ]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = leaks(corpus(rows), table)
    assert found == leaks_by_hand(rows, items)
    assert {(20, 1), (21, 2), (25, 1), (25, 2), (24, 5)} <= set(found)
    assert not [k for k in found if k[0] == 22]


def test_leaks_of_the_tables(spark, monkeypatch):
    docs, items = documents(spark), spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = leaks_by_hand(rows, [(r["item_id"], r["text"]) for r in items.collect()])
    assert leaks(docs, items) == expected and expected
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 400)
    assert leaks(docs, items) == expected


def test_blocks_find_all_within_the_radius(spark):
    rng = np.random.default_rng(2)
    rows = []
    for differ in range(22):
        a = int(rng.integers(-(1 << 63), 1 << 63))
        bits = rng.choice(64, differ, replace=False)
        b = (a & ((1 << 64) - 1)) ^ sum(1 << int(k) for k in bits)
        rows.append((differ, a, b - (1 << 64) if b >> 63 else b))
    pairs = spark.createDataFrame(rows, "differ int, a bigint, b bigint")
    from pyspark.sql import functions as F

    blocks = [decontaminate.blocks_of(F.col(c), 20) for c in "ab"]
    shared = F.size(F.array_intersect(*blocks)) > 0
    assert all(r["shared"] for r in pairs.withColumn("shared", shared).filter("differ <= 20").collect())


def test_decontaminated(spark, clashing, prose):
    item = prose(40, 1)
    docs = clashing([(1, f"x {item} y"), (2, prose(80, 2)), (None, "z"), (3, None)])
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {2, None, 3}
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == 4
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0


# Near-duplicates


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def classes_by_hand(rows):
    by_set = defaultdict(list)
    for doc_id, text in rows:
        by_set[shingle_set(text)].append(doc_id)
    sets = [s for s in by_set if s]
    near, links = {s: {s} for s in sets}, Counter()
    for i, a in enumerate(sets):
        for b in sets[:i]:
            if len(a & b) / len(a | b) >= 0.8:
                links[a] += 1
                links[b] += 1
                joined = near[a] | near[b]
                for s in joined:
                    near[s] = joined
    out = []
    for s, ids in by_set.items():
        for doc_id in ids:
            if s:
                first = min(min(by_set[x]) for x in near[s])
                out.append((doc_id, first, min(ids), len(ids), links[s]))
            else:
                out.append((doc_id, doc_id, doc_id, 1, 0))
    return sorted(out, key=repr)


def near(docs, **options):
    names = ["doc_id", "class_id", "copy_id", "n_copies", "n_links"]
    found = jaccard_forest.near_duplicates(docs, **options).select(*names)
    return sorted(map(tuple, found.collect()), key=repr)


def near_rows(prose, copies=40):
    words = prose(120, 9).split()
    rows = [(300 + i, " ".join([*words[: 116 - i % 4], str(i)])) for i in range(copies)]
    rows += [(400 + i, " ".join(words)) for i in range(5)]
    rows += [(500, "few words"), (501, "Few  WORDS"), (502, "few other words")]
    return rows


def test_near_duplicates(corpus, prose, odd_rows):
    rows = [r for r in [*odd_rows, *near_rows(prose)] if r[0] is not None]
    expected = classes_by_hand(rows)
    assert near(corpus(rows)) == expected
    assert near(corpus(rows), cell_texts=7, bucket_rows=4) == expected
    assert max(r[4] for r in expected) >= 10


def test_near_duplicates_of_the_table(spark):
    docs = documents(spark)
    assert near(docs) == classes_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_prefixes_are_shortened(corpus, prose):
    """At whole paths a forest of few trees misses links; the queries tell, and it shortens."""
    rng = random.Random(8)
    rows = []
    for group in range(60):
        words = prose(130, 700 + group).split()
        for copy in range(5):
            changed = [*words]
            for _ in range(rng.randrange(1, 4)):
                changed[rng.randrange(130)] = f"w{rng.random()}"
            rows.append((10 * group + copy, " ".join(changed)))
    docs = corpus(rows)
    options = {"trees": 4, "max_depth": 8}
    whole = jaccard_forest.measured_recall(docs, recall=0.01, **options)
    assert whole.depths == (8,) * 4 and whole.links > 8 and whole.recall < 0.9
    found = jaccard_forest.measured_recall(docs, recall=0.9, **options)
    assert found.recall >= 0.9 and found.links >= whole.links
    assert max(found.depths) - min(found.depths) <= 1 and max(found.depths) < 8
    # Queries are verified against all sets: their links are those of brute force.
    expected = classes_by_hand(rows)
    assert found.links == sum(r[4] for r in expected if r[0] % jaccard_forest.QUERIES == 0)
    assert near(docs) == expected


def test_stages_of_shortening():
    most, trees = 5, 3
    rng = np.random.default_rng(1)
    shared = rng.integers(0, most + 1, size=(200, trees))
    stage = jaccard_forest.stages_of(shared, most)
    for s in range((most - 1) * trees + 1):
        depths = jaccard_forest.stage_depths(s, trees, most)
        assert ((stage <= s) == (shared >= depths).any(axis=1)).all()
    assert (stage[(shared == 0).all(axis=1)] == (most - 1) * trees + 1).all()
    many = {0: 9_000, 4: 990, 9: 10}
    assert jaccard_forest.chosen_stage(many, 0.9, 6) == 4
    assert jaccard_forest.chosen_stage({0: 10_000, 9: 10}, 0.9, 6) == 0
    assert jaccard_forest.chosen_stage(many, 0.998, 12) == 4 and jaccard_forest.chosen_stage(many, 0.9995, 3) == 9
    # Too few links to tell: the depth that the threshold asks for, or what the links ask for.
    assert jaccard_forest.chosen_stage({0: 9}, 0.9, 6) == 6 == jaccard_forest.chosen_stage({}, 0.9, 6)
    assert jaccard_forest.chosen_stage({0: 5, 8: 5}, 0.9, 6) == 8


def test_one_of_each(corpus, clashing, prose, odd_rows):
    docs = clashing([*odd_rows, *near_rows(prose)])
    kept = jaccard_forest.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([1, 2, 3, 4, 5, 7, 8, 300, 500, 502, None], key=repr)
    assert jaccard_forest.one_of_each(corpus([])).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 7), (200, 201), (202, 201), (5, 5)]
    found = connected(spark.createDataFrame(chain, "a bigint, b bigint")).collect()
    roots = {r["vertex"]: r["root"] for r in found}
    assert roots == {i: 0 for i in [*range(31), 100]} | {i: 200 for i in (200, 201, 202)}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Repeated strings


def strings_by_hand(rows, length, keep_first):
    seen = defaultdict(list)
    data = [(text or "").encode() for _, text in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    for i in order:
        for p in range(len(data[i]) - length + 1):
            seen[data[i][p : p + length]].append((i, p))
    gone = [np.zeros(len(d), bool) for d in data]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places[1:] if keep_first else places:
                gone[i][p : p + length] = True
    out = []
    for (doc_id, _), d, g in zip(rows, data, gone):
        runs = int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~g].tobytes()
        out.append((doc_id, len(d), int(g.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def strings(docs, length, keep_first, **options):
    found = suffix_dedup.dedup_strings(docs, length, keep_first, **options).collect()
    out = []
    for r in found:
        digest = hashlib.sha256(bytes(r["data"])).hexdigest()
        out.append((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["removed"]), digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("cell", [1_500, 2])
def test_strings(corpus, prose, odd_rows, keep_first, cell):
    passage, other = prose(40, 21), prose(30, 22)
    rows = [r for r in odd_rows if r[0] != 4 and r != (5, odd_rows[5][1])]
    rows += [(50 + i, f"{prose(10, 60 + i)} {passage} {prose(10, 80 + i)}") for i in range(6)]
    rows += [(70 + i, f"{passage[i * 9:]} {other[: 90 + i]}") for i in range(5)]
    rows += [(90, f"{other}{other}"), (91, "ab" * 200), (92, "x" * 130), (93, passage[:100])]
    expected = strings_by_hand(rows, 100, keep_first)
    found = strings(corpus(rows), 100, keep_first, gram=32, cell=cell)
    assert found == expected
    assert sum(r[2] for r in expected) > 1_000


def test_strings_of_the_table(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert strings(docs, 400, False) == strings_by_hand(rows, 400, False)


def test_repeated_rows_are_copies(corpus, prose):
    text = prose(100, 1)
    rows = [(1, text), (1, text), (2, prose(100, 2)), (2, "another text of the same id " * 3)]
    assert strings(corpus(rows), 400, False) == strings_by_hand(rows, 400, False)


def test_strings_of_empty_and_clashing_tables(corpus, clashing, odd_rows):
    assert strings(corpus([]), 400, True) == []
    docs = clashing(odd_rows)
    found = suffix_dedup.dedup_strings(docs)
    assert set(found.columns) == set(docs.columns) | set(suffix_dedup.MADE)
    assert found.count() == len(odd_rows)


def common(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("keep_first", [False, True])
def test_longest_factors(keep_first):
    """The array of longest previous (and next) factors against all pairs."""
    rng = random.Random(6)
    for _ in range(40):
        letters = rng.choice(["a", "ab", "abc"]).encode()
        sizes = [rng.randrange(1, 9) for _ in range(rng.randrange(1, 6))]
        group = np.repeat(np.arange(len(sizes)), sizes)
        left, right = (
            [bytes(rng.choices(letters, k=rng.randrange(low, 9))) for _ in group] for low in (0, 1)
        )
        expected = {}
        for i, g in enumerate(group):
            others = [j for j in np.flatnonzero(group == g) if j < i or (j > i and not keep_first)]
            for d in range(len(left[i]) + 1):
                found = [common(right[i], right[j]) for j in others if common(left[i], left[j]) >= d]
                if max(found, default=0):
                    expected[i, d] = max(found)
        found = {}
        for i, near, far, n in zip(*suffix_dedup.longest_factors(group, left, right, 9, keep_first)):
            for d in range(near, far + 1):
                assert (i, d) not in found
                found[i, d] = n
        assert found == expected


def test_next_smaller_positions():
    values = np.array([0, 5, 3, 3, 7, 1, 0])
    at = np.arange(1, 6)
    assert suffix_dedup.smaller_positions(values, at, -1).tolist() == [0, 0, 0, 3, 0]
    assert suffix_dedup.smaller_positions(values, at, 1).tolist() == [2, 5, 5, 5, 6]


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("cell", [1_500, 2])
def test_repeats_too_short_to_remove(corpus, prose, keep_first, cell):
    """From `least` bytes on repeats are told of, with the longest; only longer ones are removed."""
    passage = prose(40, 31)
    rows = [(i, f"{prose(12, 40 + i)} {passage[: 50 + 9 * i]} {prose(9, 60 + i)}") for i in range(9)]
    rows += [(20, prose(60, 90)), (21, f"{passage[20:105]} {prose(3, 91)} {passage[20:95]}"), (22, "xy" * 50)]
    rows += [(23, rows[3][1]), (24, None)]
    found = suffix_dedup.dedup_strings(
        corpus(rows), 100, keep_first, gram=16, least=64, cell=cell
    ).collect()
    told = sorted((r["doc_id"], r["n_removed"], r["n_repeated"], r["longest_repeat"]) for r in found)
    longest = Counter()
    for n in range(64, 101):
        for doc_id, _, gone, _, _ in strings_by_hand(rows, n, keep_first):
            longest[doc_id] = n if gone else longest[doc_id]
    covered = {r[0]: r[2] for r in strings_by_hand(rows, 64, keep_first)}
    removed = {r[0]: r[2] for r in strings_by_hand(rows, 100, keep_first)}
    assert told == sorted((i, removed[i], covered[i], longest[i]) for i, _ in rows)
    assert sum(r[2] > 0 and r[1] == 0 for r in told) >= 3


@pytest.mark.parametrize("keep_first", [False, True])
def test_groups_that_end_with_their_documents(corpus, prose, keep_first):
    """Contexts that part only before the anchor and end together: splitting comes to an end."""
    passage = prose(25, 77)[:80]
    rows = [(i, f"{prose(8, 300 + i)}{passage}") for i in range(30)]
    rows += [(100 + i, f"{prose(8, 400 + i)}{passage}{prose(2, 500 + i)}") for i in range(30)]
    found = strings(corpus(rows), 100, keep_first, gram=16, least=64, cell=4)
    assert found == strings_by_hand(rows, 100, keep_first)
    told = suffix_dedup.dedup_strings(corpus(rows), 100, keep_first, gram=16, least=64, cell=4)
    covered = {r[0]: r[2] for r in strings_by_hand(rows, 64, keep_first)}
    assert {r["doc_id"]: r["n_repeated"] for r in told.collect()} == covered


def test_passages_of_fifty_words(corpus, prose):
    """Two documents share a passage of 51 words or more, which may take under 400 bytes."""
    rows = []
    for i in range(40):
        passage = " ".join(prose(51 + i % 20, 500 + i).split())
        rows += [(2 * i + k, f"{prose(90, 600 + 2 * i + k)} {passage} {prose(70, 800 + 2 * i + k)}") for k in (0, 1)]
    rows += [(200 + i, prose(200, 900 + i)) for i in range(40)]
    found = {r["doc_id"]: r for r in suffix_dedup.dedup_strings(corpus(rows), keep_first=False).collect()}
    for i in range(40):
        size = len(" ".join(prose(51 + i % 20, 500 + i).split())) + 2
        for k in (0, 1):
            row = found[2 * i + k]
            assert (row["n_removed"] > 0) == (size >= 400)
            assert (row["n_repeated"] > 0) == (size >= suffix_dedup.LEAST)
    assert all(found[200 + i]["n_repeated"] == 0 for i in range(40))
