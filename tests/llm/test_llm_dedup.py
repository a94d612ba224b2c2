"""Operators 1, 3, 7 and 8 against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import EDGES, frame, linked_components, normal, shingle_set, without_frequent_lines, without_repeats

from stockroom.llm import exact_dedup, line_dedup, near_dedup, suffix_dedup
from stockroom.plans import plan_counts


def test_exact_edges(spark):
    rows = exact_dedup.dedup(frame(spark, EDGES)).collect()
    groups = defaultdict(list)
    for d, t, *_ in EDGES:
        groups[hashlib.sha256(normal(t).encode()).hexdigest()].append(d)
    assert len(rows) == len(EDGES)
    for r in rows:
        ids = groups[bytes(r["digest"]).hex()]
        known = [d for d in ids if d is not None]
        assert (r["group_size"], r["keep_id"]) == (len(ids), max(known) if known else None)
    # one row of each group stays, also among rows with the same doc_id
    assert sorted(bytes(r["digest"]).hex() for r in rows if r["kept"]) == sorted(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


def test_exact_empty_and_filter(spark):
    assert exact_dedup.dedup(frame(spark, [])).count() == 0
    kept = exact_dedup.keep_first(frame(spark, EDGES))
    assert kept.columns == frame(spark, []).columns
    assert kept.count() == len({normal(t) for _, t, *_ in EDGES})


def test_index_knows_members_and_strangers(spark):
    old = exact_dedup.digests(frame(spark, [(1, "a"), (9, "A"), (2, "b")]))
    distinct = exact_dedup.winners(old)
    index = exact_dedup.build_index(distinct, 3).cache()
    new = exact_dedup.digests(frame(spark, [(100, "a"), (101, "c"), (102, "C"), (103, "d")]))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["repeat"]) for r in exact_dedup.assign(new, index, 3).collect()}
    assert got == {100: (9, 2, True), 101: (102, 2, False), 102: (102, 2, False), 103: (103, 1, False)}


def test_a_hot_digest_is_asked_once_a_batch(spark, monkeypatch):
    saved, save = [], exact_dedup.save

    def keep(df, name, **options):
        saved.append((name, save(df, name, **options)))
        return saved[-1][1]

    monkeypatch.setattr(exact_dedup, "save", keep)
    got = exact_dedup.dedup(frame(spark, [(i, "a hot text" if i < 300 else f"text {i}") for i in range(310)])).collect()
    assert sorted((r["keep_id"], r["group_size"], r["kept"]) for r in got if r["doc_id"] < 300) == [(299, 300, False)] * 299 + [(299, 300, True)]
    marked = [df for name, df in saved if name == "marked"]
    assert len(marked) == exact_dedup.BATCHES - 1
    for df in marked:
        assert df.count() <= 11 and not any(kind.startswith("array") for _, kind in df.dtypes)
        assert df.where("repeat").count() == 1  # the hot text was in the batch before


def test_batches_meet_the_index_of_those_before(spark):
    """Any number of batches gives the same; texts of a batch alone, of several, and repeated in one."""
    rnd = random.Random(6)
    docs = [(i, f"text {rnd.randrange(60)}") for i in range(150)] + [(None, "text 1"), (None, "none"), (7, "twice"), (7, "twice")]
    rows = exact_dedup.digests(frame(spark, docs))
    want = {bytes(r["digest"]): (r["doc_id"], r["rid"], r["count"]) for r in exact_dedup.winners(rows).collect()}
    for batches in (1, 2, 5):
        got = exact_dedup.keepers(rows, batches).collect()
        assert len(got) == len(want)
        assert {bytes(r["digest"]): (r["keep_id"], r["keep_rid"], r["group_size"]) for r in got} == want


def test_without_the_byte_check_the_result_is_wrong(spark, monkeypatch):
    """The perfect hash sends nonmembers to slots too: taking those for members loses texts."""
    docs = frame(spark, [(i, f"text {i}") for i in range(400)])
    members = exact_dedup._members
    assert exact_dedup.keep_first(docs).count() == 400

    def unchecked(asked, shard):
        at, _ = members(asked, shard)
        return at, at >= 0

    monkeypatch.setattr(exact_dedup, "_members", unchecked)
    assert exact_dedup.keep_first(docs).count() < 400


def test_absorbing_a_stranger_raises(spark):
    index = exact_dedup.build_index(exact_dedup.winners(exact_dedup.digests(frame(spark, [(1, "a")]))), 1)
    with pytest.raises(Exception, match="not in the index"):
        exact_dedup.absorb(index, exact_dedup.winners(exact_dedup.digests(frame(spark, [(2, "b")]))), 1).collect()


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    sizes, bits = exact_dedup.perfect_hash(keys)
    assert sorted(exact_dedup.slots_of(sizes, bits, keys)) == list(range(5000))


def _pieces(rnd):
    parts = ["".join(rnd.choice("ab\0") for _ in range(rnd.randrange(10, 80))) for _ in range(6)]
    docs = []
    for _ in range(120):
        text = ""
        for _ in range(rnd.randrange(0, 5)):
            part = rnd.choice(parts)
            i = rnd.randrange(len(part))
            text += part[i : rnd.randrange(i, len(part))] + "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(0, 20)))
        docs.append(text)
    return [*docs, "", None, "a" * 100, "xy" * 40, docs[3], docs[3]]


def test_suffix_matches_brute_force(spark):
    texts = _pieces(random.Random(7))
    rows = [(i if i < 125 else (None if i == 125 else 7), t) for i, t in enumerate(texts)]
    expected = sorted((d is not None, d or 0, *x) for (d, _), x in zip(rows, without_repeats([(t or "").encode() for t in texts], 20)))
    for hot in (50_000, 2):  # 2: grams with three contexts or more take the way for hot grams
        found = suffix_dedup.remove_repeats(frame(spark, rows), 20, 10, hot)
        got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found.collect())
        assert got == expected


def test_suffix_edges(spark):
    found = suffix_dedup.remove_repeats(frame(spark, EDGES)).collect()
    expected = without_repeats([(t or "").encode() for _, t, *_ in EDGES], 400)
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found) == sorted(expected)
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_multikey_quicksort_sorts_like_bytes():
    rnd = random.Random(3)
    strings = [bytes(rnd.choice(b"\x00ab") for _ in range(rnd.randrange(0, 9))) for _ in range(500)]
    group = np.array([rnd.randrange(3) for _ in strings], np.uint64)
    order, lcp = suffix_dedup.sorted_with_lcp(group, strings, 8)
    assert [(group[i], strings[i]) for i in order] == sorted(zip(group, strings))
    for at in range(1, len(order)):
        a, b = strings[order[at - 1]], strings[order[at]]
        same = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert lcp[at] == (same if group[order[at - 1]] == group[order[at]] else -1)


def _copies(rnd, n_groups=6):
    """Groups of near copies whose members are linked with some, not all, of their group."""
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(n_groups):
        text = [rnd.choice(words) for _ in range(rnd.randrange(40, 160))]
        for _ in range(rnd.randrange(5, 25)):
            copy = list(text)
            for _ in range(rnd.randrange(0, 6)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            rows.append(copy)
            if rnd.random() < 0.3:
                text = copy  # drifts, so that the first and the last are not alike
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_near_matches_brute_force(spark):
    rows = _copies(random.Random(11)) + [(900 + i, "the same few words again and again and so on") for i in range(3)]
    for n, share in ((3, 85), (5, 80)):
        expected = linked_components(rows, n, share)
        got = near_dedup.near_duplicates(frame(spark, rows), n, share / 100).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == expected
        assert {r["doc_id"]: r["n_shingles"] for r in got} == {d: len(shingle_set(t, n)) for d, t in rows}
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_edges(spark):
    got = near_dedup.near_duplicates(frame(spark, EDGES), 3, 0.85).collect()
    assert len(got) == len(EDGES)
    sets = {(d, t or ""): shingle_set(t, 3) for d, t, *_ in EDGES}
    sizes = sorted((d is not None, d or 0, len(s)) for (d, _), s in sets.items())
    assert sorted({(r["doc_id"] is not None, r["doc_id"] or 0, r["n_shingles"]) for r in got}) == sorted(set(sizes))
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"] and by_id[1]["kept"]
    assert by_id[4]["component_id"] == 4 and by_id[4]["kept"] and by_id[3]["component_id"] == 3
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0
    kept = near_dedup.keep_one(frame(spark, EDGES), 3, 0.85)
    assert kept.columns == frame(spark, []).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 3 in ids and 4 in ids
    # one text of a group stays, with or without doc_ids
    same = [(None, "some words that two rows without number share"), (None, "Some words that two rows without number share"), (7, "a b c d e"), (7, "A b c d e")]
    assert near_dedup.keep_one(frame(spark, same), 3, 0.85).count() == 2


def test_lines_match_brute_force(spark):
    rnd = random.Random(5)
    lines = [f"  Line number {i} is longer than forty characters, or so " for i in range(12)] + ["short", "", "\tshort "]
    rows = [(rnd.randrange(40), "\n".join(rnd.choice(lines) + (str(rnd.randrange(3)) if rnd.random() < 0.2 else "") for _ in range(rnd.randrange(0, 8)))) for _ in range(60)]
    # one text per doc_id, so that the largest doc_id names one document
    rows = list(dict(rows).items()) + [(d, t) for d, t, *_ in EDGES if d is None or d < 0 or d > 40]
    rows += [(39, "\n".join(lines)), (39, "\n".join(reversed(lines)))]
    expected = sorted((d is not None, d or 0, *x) for (d, *x) in without_frequent_lines(rows))
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_lines"], r["n_dropped"], r["kept"]) for r in line_dedup.dedup_lines(frame(spark, rows)).collect())
    assert got == expected


def test_lines_edges(spark):
    got = line_dedup.dedup_lines(frame(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[25]["n_dropped"] == 0 and by_id[20]["n_dropped"] == 1 and by_id[20]["kept"] == "0 first\nlast 0"
    assert (by_id[-5]["n_lines"], by_id[-5]["n_dropped"], by_id[-5]["kept"]) == (1, 1, "")
    assert (by_id[3]["n_lines"], by_id[4]["n_lines"], by_id[5]["n_lines"]) == (1, 1, 2)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_runs_return_new_lines_and_compact(spark):
    store = line_dedup.LineRuns(spark)
    batch = lambda names, did: spark.createDataFrame([(n.encode(), did, 0) for n in names], "line binary, did long, body long")
    seen = set()
    for did, names in enumerate(["abc", "bcd", "xyz", "ax", "q", "abcq"]):
        fresh = {bytes(r["line"]).decode() for r in store.add(batch(names, did)).collect()}
        assert fresh == set(names) - seen
        seen |= set(names)
    assert len(store.levels) > 1 and all(len(level) < line_dedup.FANOUT for level in store.levels)
    merged = {bytes(r["line"]).decode(): (r["n_docs"], r["keep"]["did"]) for r in store.merged().collect()}
    assert merged == {"a": (3, 5), "b": (3, 5), "c": (3, 5), "d": (1, 1), "x": (2, 3), "y": (1, 2), "z": (1, 2), "q": (2, 5)}


def _line_batch(spark, names, did):
    return spark.createDataFrame([(n.encode(), did, 0) for n in names], "line binary, did long, body long")


def test_runs_are_joined_without_shuffle_or_sort(spark):
    store = line_dedup.LineRuns(spark)
    for did, names in enumerate(["abc", "bcd"]):
        store.add(_line_batch(spark, names, did))
    lines = store._write(line_dedup.summed(store.merged()))
    for joined in (store._new(lines), store._counted(store.runs()[0], lines)):
        counts = plan_counts(joined)
        assert (counts["Exchange"], counts["Sort"], counts["BroadcastExchange"]) == (0, 0, 0)


@pytest.mark.parametrize("step", ["_new", "_counted"])
def test_the_result_hangs_on_each_merge(spark, monkeypatch, step):
    """Without the anti-join a line is in two runs, without the counting its documents are lost."""
    text = "a line of more than forty characters that nine documents hold"
    docs = frame(spark, [(i, text) for i in range(9)])
    dropped = lambda: sorted(r["n_dropped"] for r in line_dedup.dedup_lines(docs).collect())
    assert dropped() == [0, *[1] * 8]
    monkeypatch.setattr(line_dedup.LineRuns, step, {"_new": lambda self, lines: lines, "_counted": lambda self, run, lines: run}[step])
    assert dropped() != [0, *[1] * 8]
