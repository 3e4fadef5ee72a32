"""The training-data operators against brute force, with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from fieldsignal.llm import (
    decontaminate, licenses, packing, pages, quality, queries, simhash, suffixdedup, suffixes, tokens, toxicity, urls,
)
from fieldsignal.llm.common import table
from fieldsignal.llm.components import components

SF = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("tokenizers")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def extra():
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh é") for _ in range(150))
    period = "".join(rng.choice("ab") for _ in range(37))
    rows = [
        (None, "A null id, licensed under the MIT License."), (None, passage[20:] + "0"), (10**6, None), (10**6 + 1, ""),
        (10**6 + 2, "<|endoftext|> hi  <|endoftext|>there <|startoftext|>"),
        (10**6 + 3, "it's  we'll \n x  y Ж日本 123 ½ ² ΣΑΣ İx é x́ a՘b boo\u212a"), (10**6 + 4, "A" * 6000 + " " * 300 + "b"),
        (10**6 + 5, "de " * 900), (10**6 + 6, "xx" + "de " * 300 + "yy"), (10**6 + 7, period * 20),
        (10**6 + 8, "q" + period * 9), (10**6 + 9, "a" * 99), (10**6 + 10, "a" * 100), (10**6 + 11, "a" * 101),
        (10**6 + 12, passage), (10**6 + 13, passage[:99]), (10**6 + 14, "z" + passage[1:101] + "u"),
        (10**6 + 15, "cc by nc cc by nc CC-BY\nNC under the MIT\nlicense"), (10**6 + 16, "All rights\u00a0reserved"),
        (10**6 + 17, "one two three four " * 3000), (10**6 + 18, "\0\n\n\0"),
    ]
    return rows + [(2 * 10**6 + k, f"{rng.random()} " * 4 + passage[:80] + f" {rng.random()}" * 6) for k in range(40)]


@pytest.fixture(scope="module")
def docs(spark, extra):
    """The smallest table, edge cases, and columns whose names the operators use inside."""
    own = spark.createDataFrame(extra, "doc_id long, text string")
    both = table(spark, SF, "documents").select("doc_id", "text").union(own)
    return both.selectExpr("doc_id", "text", "1 AS fp", "2 AS __fp", "'x' AS line", "3 AS bucket", "4 AS n_words")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_token_counts(docs, empty):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    expected = [
        (x.doc_id, len((x.text or "").encode()), len(tokenizer.encode(x.text or "", add_special_tokens=False).ids))
        for x in docs.collect()
    ]
    assert rows_of(tokens.count_tokens(docs, path)) == sorted(expected, key=str)
    assert tokens.count_tokens(empty, path).count() == 0


def test_token_counts_of_repeated_rows_and_hot_pieces(spark):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    same = spark.createDataFrame([(k % 3, " the the thing " * (k % 400)) for k in range(900)], "doc_id long, text string")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    found = tokens.count_tokens(same.coalesce(1), path)
    expected = [(x.doc_id, len(x.text), len(tokenizer.encode(x.text).ids)) for x in same.collect()]
    assert rows_of(found) == sorted(expected, key=str)


@pytest.mark.parametrize("partitions", [90, 300])
def test_token_sums_are_handed_on_once_in_each_bucket(spark, partitions):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    texts = [(k, " ".join(f"the w{(k * j) % 997}" for j in range(60))) for k in range(partitions * 3)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(partitions)
    postings = tokens.map_arrow(frame, tokens._postings(path), tokens.POSTINGS)
    batch = postings.sort("group", "piece").toArrow().combine_chunks()
    chunks = set(zip(batch["group"].to_pylist(), batch["chunk"].to_pylist()))
    groups = {group for group, _ in chunks}
    assert len(groups) == -(-partitions // tokens.GROUP_PARTITIONS)
    assert max(sum(g == x for x, _ in chunks) for g in groups) <= tokens.GROUP_PARTITIONS * tokens.GROUP_CHUNKS
    assert {g for g, p in zip(batch["group"].to_pylist(), batch["piece"].to_pylist()) if p == " the"} == groups
    # One task that reads every bucket hands on one sum for a chunk.
    found = list(tokens._products(path)(iter(batch.to_batches())))
    sums = [x for b in found for x, head in zip(b["chunk"].to_pylist(), b["head"].to_pylist()) if not head]
    assert len(sums) == len(set(sums)) == len(chunks)


def test_packing(docs, empty):
    path = queries.tokenizer_path("word_bpe_49k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    expected = []
    for x in docs.collect():
        ids = np.array(tokenizer.encode(x.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for at in range(0, len(ids), 4096):
            part = ids[at : at + 4096]
            expected.append((x.doc_id, at // 4096, at, len(part), zlib.crc32(part.tobytes())))
    found = packing.pack(docs, path).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted(expected, key=str)
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= np.ceil(sum(r.length for r in found) / 4096) + 2
    assert packing.pack(empty, path).count() == 0


def pieces_of(texts, rows):
    table = pa.table({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts, type=pa.string())})
    run = packing._pieces(queries.tokenizer_path("word_bpe_49k.json"), 4096, 1)
    return [x for made in run(iter(table.to_batches(max_chunksize=rows))) for x in made.to_pylist()]


def test_packing_looks_words_up_once_for_many_texts(monkeypatch):
    """Look-ups go with the different words, which closing punctuation does not make different."""
    looked_up = []

    class Counting(packing.Memo):
        def get(self, word, *default):
            looked_up.append(word)
            return super().get(word, *default)

        def __getitem__(self, word):
            looked_up.append(word)
            return super().__getitem__(word)

        def __contains__(self, word):
            looked_up.append(word)
            return super().__contains__(word)

    memo = Counting(queries.tokenizer_path("word_bpe_49k.json"))
    monkeypatch.setattr(packing, "_memo", lambda path: memo)
    words = [f"{a}{b}qu" for a in "abcdefghij" for b in "abcdefghij"]
    texts = [" ".join(w + end for w in words for end in ("", ",", ".", "!", ").")) for _ in range(40)]
    found = pieces_of(texts, 10)
    assert len(found) == 40 and len({x["ids_crc32"] for x in found}) == 1
    assert len(looked_up) <= 4 * len(words)  # 20,000 words, 500 different ones


def test_packing_ids_of_odd_words():
    """Every character that words are made of here or not, alone and between others, and groups of any size."""
    tokenizer = tokenizers.Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    texts = [f"{c} a{c} {c}B A{c}b {c},. x{c}. '{c}s' 7{c}! {c}{c}\"" for c in map(chr, range(0x320))]
    texts += [None, "", " \n ", "it's dogs'. 'LL, we'll; <|ENDOFTEXT|> x<|endoftext|>y", "\u0130STANBUL, I\u0307", "a\u00bb, b\u00b7."]
    texts += ["", None, "Wort. " * 20_000, "\u00e9t\u00e9!? " * 9_000] + ["-- 3.5 a-b " * 20] * 30
    expected = []
    for k, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for start in range(0, len(ids), 4096):
            part = ids[start : start + 4096]
            row = (k, start // 4096, start, len(part), zlib.crc32(part.tobytes()))
            expected.append(row)
    for rows, size in ((1, 1), (7, 2_000), (1_000, 8 << 20)):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(packing, "GROUP_BYTES", size)
            assert [tuple(x.values()) for x in pieces_of(texts, rows)] == expected
    assert pieces_of([], 1) == []



@pytest.mark.parametrize("n", [1, 40, 20_000])
def test_packing_plan_holds_every_piece(n):
    lengths = np.minimum(4096, np.random.default_rng(n).lognormal(6, 1.2, n).astype(int) + 1)
    counts = np.bincount(lengths, minlength=4097)
    held = np.zeros(4097, dtype=int)
    chosen = packing.plan(counts)
    for times, pattern in chosen:
        assert sum(length * k for length, k in pattern.items()) <= 4096
        for length, k in pattern.items():
            held[length] += times * k
    assert (held == counts).all()
    assert sum(k for k, _ in chosen) <= np.ceil(lengths.sum() / 4096) * 1.02 + 1


def test_packing_plan_without_pairs():
    counts = np.zeros(4097, dtype=int)
    counts[3000] = 10**9
    assert packing.plan(counts) == [(10**9, {3000: 1})]


def fingerprints_of(docs):
    out = []
    for x in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(x.text))
        shingles = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        out.append((x.doc_id, sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))))
    return out


def simhash_classes(marked):
    parent = list(range(len(marked)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(marked)):
        for b in range(a):
            if (marked[a][1] ^ marked[b][1]).bit_count() <= 4:
                parent[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(marked):
        if doc_id is not None:
            least[find(k)] = min(doc_id, least.get(find(k), doc_id))
    return [(doc_id, f"{fp:016x}", least.get(find(k))) for k, (doc_id, fp) in enumerate(marked)]


def test_near_duplicates(docs, empty):
    small = docs.where("doc_id is null or doc_id % 3 = 0 or doc_id >= 1000000")
    assert rows_of(simhash.near_duplicates(small)) == sorted(simhash_classes(fingerprints_of(small)), key=str)
    assert simhash.near_duplicates(empty).count() == 0


def test_one_row_of_each_class_stays(docs):
    small = docs.where("doc_id is null or doc_id % 3 = 0 or doc_id >= 1000000")
    small = small.union(small)
    kept = simhash.keep_one(small)
    assert kept.columns == small.columns
    expected = {c for _, _, c in simhash_classes(fingerprints_of(small)) if c is not None}
    assert sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == sorted(expected)


@pytest.mark.parametrize("crowded", [simhash.CROWDED, 2])
def test_links_of_planted_fingerprints(spark, crowded):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(300)]
    near = []
    for fp in fps:
        for bits in range(1, 7):
            for _ in range(3):
                other = fp
                for k in rng.sample(range(64), bits):
                    other ^= 1 << k
                near.append(other)
    all_ = sorted(set(fps + near))
    signed = [x - (1 << 64) if x >> 63 else x for x in all_]
    found = components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), crowded=crowded))
    root = {r.node: r.root for r in found.collect()}
    classes = simhash_classes(list(zip(signed, all_)))
    expected = collections.defaultdict(set)
    for fp, _, c in classes:
        expected[c].add(fp)
    mine = collections.defaultdict(set)
    for fp in signed:
        mine[root.get(fp, fp)].add(fp)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (501, 501)], "a long, b long")
    assert {(r.node, r.root) for r in components(links).collect()} == {(k, 0) for k in range(201)} | {(500, 500), (501, 500)}


def suffix_digest(rows):
    seen, out = {}, []
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0))
    for doc_id, text in order:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            string = raw[k : k + 100]
            if seen.setdefault(string, (doc_id, k)) != (doc_id, k):
                gone[k : k + 100] = b"\1" * 100
        kept = bytes(c for c, x in zip(raw, gone) if not x)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("hot_runs", [2_000, 3])
def test_suffix_dedup(docs, empty, hot_runs):
    small = docs.where("doc_id is not null")
    expected = suffix_digest([(x.doc_id, x.text) for x in small.collect()])
    assert rows_of(suffixdedup.dedup_digest(small, hot_runs)) == sorted((x[:5] for x in expected), key=str)
    assert suffixdedup.dedup_digest(empty).count() == 0


def test_suffix_dedup_takes_repeated_rows_as_one(docs):
    small = docs.where("doc_id >= 1000000")
    once = rows_of(suffixdedup.dedup_digest(small))
    assert rows_of(suffixdedup.dedup_digest(small.union(small))) == sorted(once + once, key=str)


def test_texts_without_repeats(docs):
    small = docs.where("doc_id >= 1000000")
    kept = {x[0]: x[5].decode("utf-8", "ignore") for x in suffix_digest([(x.doc_id, x.text) for x in small.collect()])}
    found = suffixdedup.remove_repeats(small)
    assert found.columns == small.columns
    assert {x.doc_id: x.text or "" for x in found.collect()} == kept


def test_difference_cover_sorts_suffixes():
    rng = np.random.default_rng(1)
    block = rng.integers(97, 99, 700).astype(np.uint8)
    text = np.concatenate([block, block[:300], rng.integers(97, 99, 200).astype(np.uint8), block[50:400], np.zeros(suffixes.PAD, np.uint8)])
    places = np.arange(0, 1400)
    order, first = suffixes.sort_suffixes(text, places)
    raw = text.tobytes()
    depth = 128  # equal so far may stand in any order
    keys = [raw[p : p + depth] for p in places[order]]
    assert keys == sorted(keys)
    same = suffixes.repeats(text, places, order, first, 100)
    assert same.tolist() == [False] + [a[:100] == b[:100] for a, b in zip(keys, keys[1:])]


def contamination(docs, items):
    windows = collections.defaultdict(set)
    for name, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(name)
    sizes, out = set(map(len, windows)), []
    for x in docs.collect():
        w, hit, found = words(x.text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                names = windows.get(tuple(w[k : k + n]))
                if names:
                    found |= names
                    hit.update(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((x.doc_id, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 24, 300])
def test_contamination(spark, docs, empty, block_bytes):
    items = [tuple(x) for x in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    items += [(9001, "one two three"), (9002, None), (9003, "!"), (9004, "de"), (9005, items[0][1]), (9005, "three four one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = contamination(docs, items)
    assert rows_of(decontaminate.find_contamination(docs, bench, block_bytes)) == sorted(expected, key=str)
    kept = decontaminate.remove_contaminated(docs, bench, block_bytes)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not x[5] for x in expected)
    assert decontaminate.find_contamination(empty, bench).count() == 0
    assert {x[2] for x in decontaminate.find_contamination(docs, bench.limit(0)).collect()} == {0}


def test_longest_matches():
    bench = decontaminate.Benchmark([(1, b"a b c d e f g"), (2, b"x y z")])
    *_, shard, array = decontaminate.search([b"q a b c d z", b"e f g x y z"], bench)
    best, place = decontaminate.longest_matches(shard, array, bench)
    # the shortest window has 3 words: suffixes of the shard whose first 3 words are not in the benchmark are left out
    assert best.tolist() == [4, 3, 0, 0, 3, 2, 1, 3, 0, 0] and place[0] == 1


def longest_by_force(docs, items, window=13):
    out = {}
    for item_id, item in items:
        w = words(item)
        for start in range(len(w)):
            for doc_id, text in docs:
                d = words(text)
                for place in range(len(d)):
                    n = 0
                    while start + n < len(w) and place + n < len(d) and w[start + n] == d[place + n]:
                        n += 1
                    if n >= min(window, len(w)):
                        found = (-n, doc_id is None, doc_id or 0, place)
                        out[item_id, start] = min(out.get((item_id, start), found), found)
    return {(*k, -n, None if none else doc_id, place) for k, (n, none, doc_id, place) in out.items()}


@pytest.mark.parametrize("shard_bytes, block_bytes", [(1 << 20, 1 << 20), (90, 60), (90, 1 << 20)])
def test_longest_verbatim(spark, monkeypatch, shard_bytes, block_bytes):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 3 * shard_bytes)
    long = " ".join(f"w{k}" for k in range(40))
    items = [(1, long), (2, "one two three"), (3, None), (4, " ".join(["a"] * 20)), (5, "q " + long), (1, "a a a")]
    part = " ".join(f"w{k}" for k in range(5, 33))
    rows = [
        (10, f"x {part} y one two three"), (11, f"{part} w33 z"), (None, f"{long} end"), (12, None), (13, ""),
        (14, " ".join(["a"] * 17)), (14, " ".join(["a"] * 17)), (15, "W1 w2 w3 one, two; THREE"), (16, " ".join(["z"] * 300)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    found = decontaminate.longest_verbatim(docs, bench, block_bytes=block_bytes)
    assert {(r.item_id, r.start, r.length, r.doc_id, r.place) for r in found.collect()} == longest_by_force(rows, items)
    judged = decontaminate.find_contamination(docs, bench, block_bytes)
    assert rows_of(judged) == rows_of(decontaminate.find_contamination(docs, bench))
    kept = decontaminate.remove_contaminated(docs, bench, block_bytes)
    assert kept.count() == judged.where("not contaminated").count()
    assert decontaminate.longest_verbatim(docs.limit(0), bench).count() == 0
    assert decontaminate.longest_verbatim(docs, bench.limit(0)).count() == 0


def license_row(text):
    w, at, base = words(text), [], set()
    for phrase, label in licenses.PHRASES:
        q = phrase.split()
        for k in range(len(w) - len(q) + 1):
            if w[k : k + len(q)] == q:
                at.append(k)
                base.add(label)
    labels, best = set(base), 0.0
    for line in (text or "").split("\n"):
        block = set(words(line))
        for template, label in licenses.TEMPLATES:
            t = set(template.split())
            needed, barred = licenses.naming(template, label)
            if len(t & block) >= licenses.THRESHOLD * len(t) - 1e-9 and block.issuperset(needed) and block.isdisjoint(barred):
                labels.add(label)
                best = max(best, len(t & block) / len(t))
    first, last = min(at, default=None), max(at, default=None)
    return len(w), len(at), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else best


def test_licenses(docs, empty):
    small = docs.where("doc_id is null or doc_id % 2 = 0 or doc_id >= 1000000")
    small = small.union(small.where("doc_id is null"))
    expected = [(x.doc_id, *license_row(x.text)) for x in small.collect()]
    assert rows_of(licenses.scan(small)) == sorted(expected, key=str)
    assert licenses.scan(empty).count() == 0


@pytest.mark.parametrize(
    ("notice", "labels"),
    [
        ("Released under the MIT License.", "mit"),
        ("Licensed under the Apache License, Version 2.0.", "apache-2"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
        ("This work is licensed under the GNU General Public License, version 2.", "gpl-2"),
        ("Licensed under the GNU Lesser General Public License.", "lgpl"),
        ("Licensed under the Mozilla Public License, version 2.0.", "mpl-2"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("Licensed under CC BY-SA 4.0.", "cc-by-sa"),
        ("Licensed under CC BY 4.0.", "cc-by"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
        ("All rights reserved.", "proprietary"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
        ("Licensed under the license of the house.", ""),
    ],
)
def test_notices_get_their_own_label_alone(spark, notice, labels):
    frame = spark.createDataFrame([(1, f"Der Fluss.\n{notice}\nThe end.")], "doc_id long, text string")
    assert licenses.scan(frame).first().labels == labels


def url_row(url, rules):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = lower(host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls(spark):
    rules = [*urls.RULES, ("com", "/en/a", "block"), ("com", "/e", "block"), ("a.com", "", "block"), ("org", "/x\U0010ffff", "block")]
    made = [
        None, "nothing", "http://WWW.Example.COM/en/x?y://", "http://a.example.com/en/", "http://com/", "http://com",
        "http://x.com?/en/", "http://example.com/en/\U0010ffff/z", "http://notexample.com/en/q", "x://net/es/#a",
        "a\nb://fr.net/fr/", "a\nb://fr.net/fr/", "://.com/", "http://b.a.com", "http://b.a.com/en/ab", "u://q.org/x\U0010ffff\U0010ffff",
        "http://z.com/e", "http://z.com/en/b", "http://z.com/f", "://",
    ]
    frame = table(spark, SF, "pages").select("page_id", "url").union(
        spark.createDataFrame([(-k, x) for k, x in enumerate(made)], "page_id long, url string")
    ).selectExpr("*", "'h' AS host", "'s' AS salt")
    expected = [(x.page_id, *url_row(x.url, rules)) for x in frame.collect()]
    assert rows_of(urls.judge(frame, urls.rules_table(spark, rules))) == sorted(expected, key=str)
    assert urls.judge(frame.limit(0), urls.rules_table(spark, rules)).count() == 0
    assert {x.verdict for x in urls.judge(frame, urls.rules_table(spark, rules).limit(0)).collect()} == {"allow"}


def test_main_text(spark):
    tree = pages.train(spark)
    page = (
        '<html><head><title>T</title></head><body><nav><ul><li><a href="/a">a</a></ul></nav><div class="ad">Buy this now</div>'
        "<article><h1>The  title</h1><p>First &amp; <b>best</b>\nparagraph.<p>Second<br>one.</p>"
        '<div class="comments"><p>I like it very much indeed.</p></div></article><script>var t = "</p>";</script>'
        "<form>Name <input></form><footer>&copy; me</footer></body></html>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (3, "u", ""), (4, "u", "<p"), (5, "u", "<a href='" * 3000), (6, "u", page[:400])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' AS text")
    found = {x.page_id: x for x in pages.extract(frame, tree).collect()}
    assert found[1].text == "The title\nFirst & best paragraph.\nSecond one." and found[1].n_chars == len(found[1].text)
    assert [found[k].text for k in (2, 3, 5)] == ["", "", ""]
    assert found[6].text.startswith("The title\nFirst & best paragraph.")
    assert pages.extract(frame, tree).count() == len(rows) and pages.extract(frame.limit(0), tree).count() == 0


def test_tree_agrees_with_its_table(spark):
    table_ = np.array(pages.LABELLED, dtype=float)
    assert (pages.classify(pages.train(spark), table_[:, :-1]) == table_[:, -1]).mean() > 0.95


def test_segments_are_maximal():
    rng = random.Random(2)

    def recursive(scores, lo, hi):
        best = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += scores[b]
                if total > 0 and (best is None or total > best[2] + 1e-9):
                    best = (a, b + 1, total)
        return [] if best is None else recursive(scores, lo, best[0]) + [best] + recursive(scores, best[1], hi)

    for _ in range(60):
        scores = [rng.choice([-1.5, -1.0, -0.25, 2.0, 3.5, 0.7]) + rng.random() * 1e-3 for _ in range(25)]
        mine, theirs = toxicity.segments(scores), recursive(scores, 0, len(scores))
        assert [x[:2] for x in mine] == [x[:2] for x in theirs]


def test_toxicity(spark, docs, empty):
    rng = random.Random(4)
    plain, bad = [f"w{k}a" for k in range(0)] + ["tree", "house", "river", "stone", "cloud", "paper"], ["scumbag", "idiotic", "loserly"]
    plain = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for k in range(900):
        text = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        toxic = int(k % 6 == 0)
        if toxic:
            at = rng.randrange(len(text))
            text[at:at] = [rng.choice(bad) for _ in range(3)]
        rows.append((k, " ".join(text)))
        labels.append((k, 1, toxic))
    rows += [(None, "x idiotic scumbag loserly"), (2000, None), (2001, ""), (5, rows[5][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = toxicity.score(frame, known).collect()
    assert len(found) == len(rows) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in found)
    truth = dict((k, t) for k, _, t in labels)
    tested = [x for x in found if x.held_out and x.doc_id in truth]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in found if x.doc_id is not None)
    assert sum(x.predicted == truth[x.doc_id] for x in tested) >= 0.97 * len(tested)
    assert [x.predicted for x in found if x.doc_id is None] == [1]
    assert {x.predicted for x in toxicity.score(frame, known.limit(0)).collect()} == {0}
    assert toxicity.score(frame.limit(0), known).count() == 0


def test_held_out_labels_are_never_read(spark):
    frame = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    flipped = labels.selectExpr(
        "doc_id", "quality", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - toxic, toxic) AS toxic"
    )
    a, b = (rows_of(toxicity.score(frame, x).drop("passages")) for x in (labels, flipped))
    assert a == b


def test_quality(spark, docs, empty):
    trusted = table(spark, SF, "labels").where("quality = 1")
    judged = quality.judge(docs, trusted)
    expected = []
    for x in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", x.text or "")
        counts, covered, seen, copies = collections.Counter(zip(w, w[1:], w[2:])), set(), set(), 0
        for k in range(len(w) - 2):
            if counts[tuple(w[k : k + 3])] > 1:
                covered |= {k, k + 1, k + 2}
        for line in (x.text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                copies += line in seen
                seen.add(line)
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        signs = sum((x.text or "").count(s) for s in "#*$%&|<>")
        expected.append((x.doc_id, len(w), sum(map(len, w)), signs, copies, len(covered), failed))
    assert rows_of(judged.drop("llr", "kept")) == sorted(expected, key=str)
    for x in judged.collect():
        assert x.kept == (not x.base_failed and x.llr >= quality.THRESHOLD)
    kept = quality.keep_good(docs, trusted)
    assert kept.columns == docs.columns and kept.count() == judged.where("kept").count()
    assert quality.judge(empty, trusted).count() == 0
    assert {x.llr for x in quality.judge(docs, trusted.limit(0)).collect()} == {0.0}


def test_quality_ratios_by_hand(spark):
    raw, good = ["tree house tree", "| x | y | z"], ["tree house tree"]
    memo, counts = quality.Bins(), []
    for texts in (good, raw):
        counts.append(np.bincount(np.concatenate([quality.bins(t, memo) for t in texts]), minlength=quality.BUCKETS))
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(raw)], "doc_id long, text string")
    weights = quality.ratios(*counts)
    judged = {x.doc_id: x.llr for x in quality.judge(frame, frame.where("doc_id = 0")).collect()}
    for k, text in enumerate(raw):
        assert judged[k] == pytest.approx(weights[quality.bins(text, memo)].mean())
    assert judged[0] > 0 > judged[1]


@pytest.mark.parametrize("sample_rows", [5, quality.TRUSTED_ROWS])
def test_quality_verdict_equals_brute_force(spark, docs, sample_rows):
    """The ratio from counters of n-grams instead of arrays, over the same bins."""
    trusted = table(spark, SF, "labels").where("quality = 1").select("doc_id")
    ids = trusted.distinct().selectExpr("doc_id", "xxhash64(doc_id) AS h").orderBy("h", "doc_id").limit(sample_rows)
    ids = {x.doc_id for x in ids.collect()}

    def grams(text):
        parts = [xxhash.xxh32_intdigest(x) for x in re.findall(r"\w+|[^\w\s]+", text or "")]
        pairs = [((a * 0x9E3779B1 ^ b) * 0x85EBCA77 % 2**64) >> 13 for a, b in zip(parts, parts[1:])]
        return [x % quality.BUCKETS for x in parts + pairs]

    rows = [(x.doc_id, x.text, grams(x.text)) for x in docs.select("doc_id", "text").collect()]
    raw = collections.Counter(g for _, _, found in rows for g in found)
    good = collections.Counter(g for i, _, found in rows if i in ids for g in found)
    n_raw, n_good = sum(raw.values()), sum(good.values())

    def weight(g):
        q = (raw[g] + 1) / (n_raw + quality.BUCKETS)
        p = 0.99 * (good[g] + quality.PRIOR * q) / (n_good + quality.PRIOR) + 0.01 * q
        return np.log(p / q)

    means = sorted((str(i), sum(map(weight, f)) / len(f) if f else 0.0) for i, _, f in rows)
    judged = quality.judge(docs, trusted, sample_rows=sample_rows).collect()
    assert [x for _, x in means] == pytest.approx([x for _, x in sorted((str(x.doc_id), x.llr) for x in judged)], abs=1e-9)
    for x in judged:
        assert x.kept == (not x.base_failed and x.llr >= quality.THRESHOLD)


def test_quality_tells_labelled_texts_apart(spark):
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    judged = quality.judge(table(spark, "/root/testdata/sf0.01", "documents"), labels.where("quality = 1"))
    known = judged.join(labels, "doc_id").where("not base_failed").collect()
    assert all(x.kept == bool(x.quality) for x in known)


@pytest.mark.parametrize(("sf", "bad_found"), [("sf0.001", 0), ("sf0.01", 27)])
def test_quality_keeps_good_texts_outside_the_fit(spark, sf, bad_found):
    labels = table(spark, f"/root/testdata/{sf}", "labels")
    judged = quality.judge(table(spark, f"/root/testdata/{sf}", "documents"), labels.where("quality = 1 and doc_id % 2 = 0"))
    known = judged.join(labels, "doc_id").where("not base_failed").collect()
    good = [x.kept for x in known if x.quality == 1 and x.doc_id % 2]
    assert len(good) > 30 and all(good)
    assert sum(not x.kept for x in known if x.quality == 0) >= bad_found


def test_quality_of_thin_evidence():
    raw = np.full(quality.BUCKETS, 1000)
    few, many = np.zeros(quality.BUCKETS, dtype=int), np.zeros(quality.BUCKETS, dtype=int)
    few[:100], many[:100] = 1, 10**6
    assert quality.ratios(few, raw)[100:].min() > -0.01
    assert quality.ratios(many, raw)[100:].max() < -4


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<html><head><title>T</title><meta charset=x><body><p>One</p>", ["One"]),
        ("<head><title>T</title><script>'<p>'</script>stray<p>One</p><p>Two</p>", ["One", "Two"]),
        ("<head><title>T</title>stray</head>One<p>Two", ["One", "Two"]),
        ("<p>One <svg width='1' />more</p><p>Two</p><svg><text>x</text></svg>Three", ["One more", "Two", "Three"]),
        ("<p>One</p><datalist><option>a<option>b</datalist><p>Two</p>", ["One", "Two"]),
        ("<select><option>a<option>b</select><p>Two</p>", ["Two"]),
        ("<button>go<p>One</p><button>go</button><p>Two</p>", ["One", "Two"]),
        ("<object><object>a</object>b</object><p>One</p>", ["One"]),
        ("<p>One</p><!-- <svg> <p>Two</p>", ["One"]),
        ("<p>One</p><style>p {} <p>Two</p>", ["One"]),
    ],
)
def test_silent_elements_end(html, expected):
    assert [text for text, _ in pages.blocks(html)] == expected


LONG = "The river rose by two metres in the night and the village had to leave its houses before the morning came."


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "share-enabled", "sidebar-right", "sidebar"])
@pytest.mark.parametrize("outer", ["", "<main>"])
def test_wrappers_of_an_article_are_not_asides(spark, name, outer):
    page = f"{outer}<div class='{name}'><article><header class='entry-header'><h1>The flood</h1></header><p>{LONG}</p></article></div>"
    frame = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert pages.extract(frame, pages.train(spark)).first().text == f"The flood\n{LONG}"


@pytest.mark.parametrize(
    "part",
    [
        "<div class='left-sidebar'>{}</div>", "<div class='comment-list'>{}</div>", "<div id=ad-1>{}</div>",
        "<aside><article>{}</article></aside>", "<div class=comments><article class='comment-body'>{}</article></div>",
        "<article><p>Text</p><div class='related-posts'><article>{}</article></div></article>",
        "<div role=navigation>{}</div>", "<div class='site-header'>{}</div>", "<form>{}</form>",
    ],
)
def test_other_parts_stay_asides(part):
    found = [f for text, f in pages.blocks("<p>One</p>" + part.format("Other words") + "<p>Two</p>") if text == "Other words"]
    assert [f[4] for f in found] == [True]


def test_long_text_of_a_named_part_of_an_article(spark):
    page = f"<article><h1>The flood</h1><div class='widget'><p>{LONG * 10}</p></div><div class='widget'><p>Buy this</p></div></article>"
    page += f"<div class='cookie-notice'><p>{LONG * 10}</p></div>"
    frame = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert pages.extract(frame, pages.train(spark)).first().text == f"The flood\n{LONG * 10}"


@pytest.mark.parametrize("m", [1, 7, 10**6])
def test_packing_plan_of_patterns_that_are_not_full(m):
    counts = np.zeros(4097, dtype=int)
    counts[[2056, 1042, 1032, 1002]] = 6 * m, 6 * m, 6 * m, 12 * m
    held, chosen = np.zeros(4097, dtype=int), packing.plan(counts)
    for times, pattern in chosen:
        assert sum(length * k for length, k in pattern.items()) <= 4096
        for length, k in pattern.items():
            held[length] += times * k
    assert (held == counts).all() and sum(k for k, _ in chosen) == 9 * m


def test_contamination_with_a_block_without_words(spark):
    items = [(1, "one two three"), (2, "!"), (3, "four five")]
    docs = spark.createDataFrame([(1, "zero one two three four five"), (2, "none of it"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    found = decontaminate.find_contamination(docs, bench, 1)
    assert rows_of(found) == sorted(contamination(docs, items), key=str)
    assert [x.doc_id for x in decontaminate.remove_contaminated(docs, bench, 1).orderBy("doc_id").collect()] == [2, 3]


def test_links_of_a_hub_are_dealt_to_buckets(spark):
    from fieldsignal.llm.components import _with_least

    links = spark.createDataFrame([(0, k) for k in range(1, 2001)] + [(5000, 5001)], "a long, b long")
    laid = _with_least(links.selectExpr("b as v", "a as u"), 2001)
    assert laid.groupBy("u", "bucket").count().agg({"count": "max"}).first()[0] < 100
    assert {(r.u, r.m) for r in laid.select("u", "m").distinct().collect()} == {(0, 1), (5000, 5001)}
    assert {r.root for r in components(links).collect()} == {0, 5000}


def test_keep_one_with_repeated_rows_and_clashing_names(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(2, text, 1), (1, text, 2), (1, text, 2), (None, text, 3), (None, "alone here", 4), (7, None, 5), (8, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash int")
    found = sorted(map(tuple, simhash.keep_one(docs).collect()), key=str)
    assert found == sorted([(1, text, 2), (None, "alone here", 4), (7, None, 5)], key=str)


def test_license_blocks_are_extracted_once(spark):
    """The order of the words and the candidates come from one written table of known words; before, both split all lines."""
    from fieldsignal.llm import licenses

    rows = [(1, "Some prose, and more\nLicensed under the MIT License."), (2, "nothing known"), (3, None)]
    fits = licenses.similar_blocks(spark.createDataFrame(rows, "doc_id long, text string"), licenses.TEMPLATES)
    assert "regexp_extract_all" not in fits._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.doc_id, r.label, r.score) for r in fits.collect()} == {(1, "mit", 1.0), (1, "mit", 0.8)}
