"""The full-text index and the removal of repeated word passages against brute force, with edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from fieldsignal.llm import fmindex, worddedup


def sequences(rng, number, letters, longest):
    return [[rng.randrange(1, letters + 1) for _ in range(rng.randrange(1, longest))] for _ in range(number)]


@pytest.mark.parametrize("letters", [1, 2, 5, 300])
def test_index_counts_equal_brute_force(letters):
    rng = random.Random(letters)
    texts = sequences(rng, 30, letters, 40)
    weights = np.array([rng.randrange(1, 4) for _ in texts])
    symbols = np.array([s for t in texts for s in [*t, 0]])
    index = fmindex.FMIndex(symbols, weights)
    for size in (1, 2, 3, 6):
        counts = Counter()
        for t, w in zip(texts, weights.tolist()):
            for k in range(len(t) - size + 1):
                counts[tuple(t[k : k + size])] += w
        whole = np.flatnonzero([0 not in symbols[k : k + size] for k in range(len(symbols) - size + 1)])
        for least in (1, 2, 5):
            stop = index.search(symbols, whole, whole + size - 1, least)
            for k, s in zip(whole.tolist(), stop.tolist()):
                assert (s < k) == (counts[tuple(symbols[k : k + size].tolist())] >= least)


@pytest.mark.parametrize("letters, longest", [(2, 60), (3, 30), (1, 50), (40, 80)])
def test_repeated_windows_equal_brute_force(letters, longest):
    rng = random.Random(letters * longest)
    texts = sequences(rng, 40, letters, longest)
    texts += [t[2:] + [letters] for t in texts[:10]]
    texts = [t for t in texts if len(t) >= 5]
    weights = np.array([rng.choice([1, 1, 1, 2]) for _ in texts])
    counts = Counter()
    for t, w in zip(texts, weights.tolist()):
        for k in range(len(t) - 4):
            counts[tuple(t[k : k + 5])] += w
    symbols = np.array([s for t in texts for s in [*t, 0]])
    ends = np.flatnonzero(symbols == 0)
    begins = np.r_[0, ends[:-1] + 1]
    from_, to = fmindex.repeated(fmindex.FMIndex(symbols, weights), symbols, begins, ends - 5, 5)
    found = {k for a, b in zip(from_.tolist(), to.tolist()) for k in range(a, b + 1)}
    expected = {
        b + k for b, t in zip(begins.tolist(), texts) for k in range(len(t) - 4) if counts[tuple(t[k : k + 5])] > 1
    }
    assert found == expected


def plain(rows):
    n = worddedup.WINDOW
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    counts = Counter(tuple(w[k : k + n]) for w in texts for k in range(len(w) - n + 1))
    out = []
    for (doc, _), w in zip(rows, texts):
        gone = {j for k in range(len(w) - n + 1) if counts[tuple(w[k : k + n])] > 1 for j in range(k, k + n)}
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)

    def fresh(n):
        return " ".join(str(rng.random())[2:8] for _ in range(n))

    passage, line, common = fresh(60), fresh(15), fresh(40)
    out = [(k, fresh(rng.randrange(0, 200))) for k in range(60)]
    out += [(100 + k, f"{fresh(30)}\n{passage}\t{fresh(30)}") for k in range(5)]  # a shared passage
    out += [(200 + k, f"{fresh(40)} {line} {fresh(40)}") for k in range(40)]  # a common line, no window alike
    out += [(300 + k, f"{fresh(k % 7)} {common} {fresh(k % 5)}") for k in range(40)]
    out += [(400 + k, out[7][1] + " " + fresh(50)) for k in range(30)]  # copies
    out += [(500, None), (501, ""), (502, " \t\n "), (503, "a " * 34), (504, "b " * 35), (505, "c " * 36), (506, "d e " * 900)]
    out += [(507, passage.split(" ", 26)[26]), (508, passage.split(" ", 25)[25]), (509, " é Ж日 x " * 50)]
    out += [(510, fresh(20_000)), (511, f"{fresh(5)} {passage} {fresh(50)} {passage}")]
    repeated = (600, fresh(80))
    out += [repeated, repeated, (600, fresh(70)), (None, fresh(90)), (None, passage), (None, None)]
    once = fresh(60)
    return out + [(700, f"{once} {once}"), (701, f"X{once}"), (702, once + "X")]


def as_rows(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("hot_runs", [3, worddedup.HOT_RUNS])
def test_removal_equals_brute_force(spark, rows, hot_runs):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS doc", "2 AS tag", "3 AS starts")
    found = worddedup.remove_repeated(df.repartition(6), hot_runs)
    assert as_rows(found) == plain(rows)


def test_pieces_of_a_task_equal_brute_force(rows, monkeypatch):
    """Chunks, runs that are compared and shards of a few texts each, without a session."""
    import pyarrow as pa

    monkeypatch.setattr(worddedup, "CHUNK_BYTES", 2_000)
    monkeypatch.setattr(worddedup, "HELD_BYTES", 3_000)
    monkeypatch.setattr(worddedup, "SHARD_BYTES", 2_000)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], names=["doc_id", "text"]
    )
    runs = pa.Table.from_batches(list(worddedup._find_runs(iter([batch])))).to_pylist()
    alone = Counter(r["route"] for r in runs if r["kind"] != worddedup.KNOWN)
    packed = pa.Table.from_batches(list(worddedup._pack(iter([batch])))).to_pylist()
    held = {}
    for r in runs:
        if r["kind"] == worddedup.KNOWN or r["kind"] == worddedup.FIRST and alone[r["route"]] > 1:
            bucket = r["content"] if r["kind"] == worddedup.KNOWN else r["route"]
            run = {"pos": r["pos"], "bucket": bucket, "size": r["size"], "hot": bucket % 3 == 0}
            held.setdefault((r["doc"], r["pos"] >> 32), {})[r["pos"]] = run
    joined = [{**p, "runs": list(held[p["doc"], p["tag"]].values())} for p in packed if (p["doc"], p["tag"]) in held]
    cut = pa.Table.from_batches(list(worddedup._cut(iter(pa.Table.from_pylist(joined).to_batches(max_chunksize=4)))))
    segments = cut.filter(pa.compute.is_valid(cut["words"])).sort_by([("bucket", "ascending"), ("words", "ascending")])
    found = pa.Table.from_batches(list(worddedup._search(iter(segments.to_batches(max_chunksize=3))))).to_pylist()
    by_run = {}
    for f in found:
        by_run.setdefault((f["doc"], f["pos"]), set()).add((f["first"], f["size"]))
    starts = {}
    owners = [(d, p, d, p) for d, p in by_run]
    owners += [(c["doc"], c["pos"], c["of_doc"], c["of_pos"]) for c in cut.to_pylist() if c["words"] is None]
    for doc, pos, of_doc, of_pos in owners:
        for first, size in by_run.get((of_doc, of_pos), ()):
            starts.setdefault((doc, pos >> 32), set()).add(((pos & 0xFFFFFFFF) + first << 31) + size)
    kept = [{**p, "starts": list(starts.get((p["doc"], p["tag"]), ())) or None} for p in packed]
    out = pa.Table.from_batches(list(worddedup._kept(iter(pa.Table.from_pylist(kept).to_batches())))).to_pylist()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in out), key=str) == plain(rows)


def test_empty_table(spark, rows):
    df = spark.createDataFrame(rows[:3], "doc_id long, text string").limit(0)
    assert worddedup.remove_repeated(df).collect() == []


def test_spans_cover_the_removed_words(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in worddedup.remove_repeated(df).collect():
        assert sum(s["last"] - s["first"] + 1 for s in r["spans"]) == r["n_removed"]
