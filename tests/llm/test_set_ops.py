"""Language model, similarity join, packing, search, sharding and the pipeline against brute force."""

import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pairloom.llm import eliasfano, graph, hamming, jaccard, lm_trie, packing, queries, resharding
from pairloom.runtime import shared_dir

DOCS = "doc_id long, text string"


def lowered(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.mark.parametrize(("n", "top"), [(1, 1), (5, 6), (1000, 1001), (1000, 10**6), (20_000, 2**40), (300, 2**62)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, top, n)).astype(np.uint64)
    sequence = eliasfano.EliasFano(eliasfano.from_blob(eliasfano.to_blob(eliasfano.EliasFano.build(values, "x."))), "x.")
    asked = np.unique(np.r_[values, rng.integers(0, 2 * top, n).astype(np.uint64), np.uint64(0)])
    place = {int(v): i for i, v in enumerate(values)}
    assert sequence.find(asked).tolist() == [place.get(int(x), -1) for x in asked]
    assert eliasfano.EliasFano(eliasfano.EliasFano.build(values[:0], "x."), "x.").find(asked).tolist() == [-1] * len(asked)


def brute_model(texts, train):
    """log10 probabilities by the definition, without quantising: interpolation with the shorter context."""
    grams = [Counter() for _ in range(4)]
    rows = [["\n", *lowered(t), "\n"] for t in texts]
    for row, use in zip(rows, train, strict=True):
        if use:
            for i in range(1, len(row)):
                for n in (1, 2, 3):
                    if i - n + 1 >= 0:
                        grams[n][tuple(row[i - n + 1 : i + 1])] += 1
    total, types = sum(grams[1].values()), len(grams[1])
    follow = Counter()
    for g, c in grams[3].items():
        follow[g[:2]] += c
    out = []
    for row in rows:
        score = base = known = 0
        for i in range(1, len(row)):
            c = grams[1][row[i],]
            p = (c + 0.5) / (total + 0.5 * (types + 1))
            known += c > 0
            base += math.log10(p)
            if u := grams[1][row[i - 1],]:
                p = (grams[2][row[i - 1], row[i]] + lm_trie.PRIOR[2] * p) / (u + lm_trie.PRIOR[2])
            if i > 1 and (tu := grams[2][row[i - 2], row[i - 1]]):
                p = (grams[3][row[i - 2], row[i - 1], row[i]] + lm_trie.PRIOR[3] * p) / (tu + lm_trie.PRIOR[3])
            score += math.log10(p)
        out.append((len(row) - 1, known, total, base, score))
    return out


def test_language_model(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(900, None), (901, ""), (902, "The the THE"), (902, "The the THE")]
    train = [zlib.crc32(str(d).encode()) % 5 != 1 for d, _ in rows]
    got, model = lm_trie.score(spark.createDataFrame(rows, DOCS).withColumn("score", F.lit(1)), queries.fold(5) != 1)
    want = brute_model([t for _, t in rows], train)
    key = lambda d, h: (d, h)
    found = {key(r.doc_id, r.held_out): r for r in got.collect()}
    for (d, _), use, (n, known, total, base, score) in zip(rows, train, want, strict=True):
        r = found[key(d, not use)]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and abs(r.score - score) < 0.02 * n + 0.05
    assert got.count() == len(rows)
    held = [(r.score, r.base_score) for r in found.values() if r.held_out]
    assert sum(s for s, _ in held) > sum(b for _, b in held)
    assert len(model) == 2 and all(m.count() >= 1 for m in model)


def test_language_model_edges(spark):
    none = spark.createDataFrame([], DOCS)
    assert lm_trie.score(none, F.lit(True))[0].count() == 0
    unseen = lm_trie.score(spark.createDataFrame([(1, "a b"), (2, None)], DOCS), F.lit(False))[0].orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in unseen] == [(3, 0, 0), (1, 0, 0)]
    assert all(r.score == r.base_score for r in unseen)


def test_language_model_leaves_little_on_disk(spark, documents):
    """Requests for words go once they are answered, tries that nobody asked for are not stored, and blocks span the batches of a task."""
    before = set(Path(shared_dir(spark).removeprefix("file:")).iterdir())
    docs = documents.coalesce(1)
    kept, model = lm_trie.score(docs, queries.fold(5) != 1, keep_model=False)
    folders = {p.name.split("-")[0]: p for p in set(Path(shared_dir(spark).removeprefix("file:")).iterdir()) - before}
    assert model == [] and [p.name for p in folders["tokens"].iterdir() if p.is_dir()] == ["kept=true"]
    assert spark.read.parquet(str(folders["answers"])).where("block < 0").count() == 0
    rows = spark.read.schema(lm_trie.ROWS).parquet(str(folders["tokens"]))
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert rows.count() <= 1 + 2 * chars // lm_trie.BLOCK_BYTES
    same = lm_trie.score(docs, queries.fold(5) != 1)[0]
    assert kept.exceptAll(same).isEmpty() and kept.count() == same.count()


def test_look_ups_select_once(monkeypatch):
    """A bucket's end is read from the bits behind its begin; it is selected only for buckets that reach the next word."""
    rng = np.random.default_rng(6)
    selected, select = [], eliasfano._select_in_word
    monkeypatch.setattr(eliasfano, "_select_in_word", lambda word, rank: selected.append(len(word)) or select(word, rank))
    scattered = np.unique(rng.integers(0, 2**40, 5000))
    for values in (scattered, np.arange(1000), np.arange(500) + 2**50, np.unique(np.r_[rng.integers(0, 2**20, 300) + 2**33, np.arange(400) * 2**30]), np.array([0]), np.r_[np.arange(9000), 2**62], np.zeros(0)):
        values = values.astype(np.uint64)
        wanted = np.r_[values, values + np.uint64(1), rng.integers(0, 2**63, 1000, dtype=np.uint64), np.arange(300, dtype=np.uint64)]
        place = {int(v): i for i, v in enumerate(values)}
        selected.clear()
        found = eliasfano.EliasFano(eliasfano.EliasFano.build(values, ""), "").find(wanted)
        assert found.tolist() == [place.get(int(w), -1) for w in wanted]
        assert len(values) != len(scattered) or sum(selected) < 1.2 * len(wanted)
    words = rng.integers(1, 2**64 - 1, 500, dtype=np.uint64) & rng.integers(1, 2**64 - 1, 500, dtype=np.uint64)
    for word in [*(w for w in words.tolist() if w), 2**64 - 1, 1, 1 << 63]:
        places = [i for i in range(64) if word >> i & 1]
        assert select(np.full(len(places), word, np.uint64), np.arange(len(places))).tolist() == places


def test_language_model_on_disk_is_short(spark, monkeypatch):
    """Frequent words take a byte, and what codes mean is stored once a shard, not in each answer."""
    rng = np.random.default_rng(4)
    codes = np.minimum(rng.zipf(1.2, 50_000), 2_000_000).astype(np.int64)
    for some in (codes, codes[:0], np.array([191, 192, 255, 256]), np.array([5 << 40, 0])):
        assert lm_trie._long(*lm_trie._uncrush(lm_trie._crush(*lm_trie._short(some)))).tolist() == some.tolist()
    first, rest, _ = lm_trie._short(np.arange(10_000) % 200)
    assert first.itemsize == rest.itemsize == 1 and len(rest) == 400

    monkeypatch.setattr(lm_trie, "SHARD_CHARS", 4_000)
    before = set(Path(shared_dir(spark).removeprefix("file:")).iterdir())
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in rng.zipf(1.3, 400))) for i in range(60)], DOCS)
    lm_trie.score(docs, F.lit(True), keep_model=False)[0].count()
    for folder in set(Path(shared_dir(spark).removeprefix("file:")).iterdir()) - before:
        if folder.name.startswith("answers"):
            rows = spark.read.parquet(str(folder))
            shards = rows.select("shard").distinct().count()
            assert rows.count() > 2 * shards > 2 and rows.where("book IS NOT NULL").count() == shards


def test_blocks_span_batches():
    batches = [pa.record_batch({"text": pa.array([t], pa.string())}) for t in ["a" * 1000, None, "b" * 500, "c" * (5 << 20), "d"]]
    assert [b.num_rows for b in lm_trie._together(iter(batches))] == [3, 1, 1]


def test_requests_tell_contexts_apart(monkeypatch):
    """Of contexts beyond ``HOT`` the occurrences are sent, of the others they are the sum over all blocks."""
    monkeypatch.setattr(lm_trie, "HOT", 2)
    words = np.array([5, 6, 5, 6, 5, 7, 9], dtype=np.uint64)  # numbers of the words; the last ends the text
    counts = np.array([3, 2, 3, 2, 3, 1, 1])
    blobs = []
    for train in (1, 0):
        block = lm_trie.Block(lm_trie._crush(np.array([train], np.uint8), np.array([7], np.uint8), np.arange(7, dtype=np.uint8)), 1, 7, 4)
        block.take({0: lm_trie._crush(words, counts)})
        blobs += [b for _, b in block.requests()]
    context, word, times, context_n, low = lm_trie._gather(blobs)
    assert list(zip(context.tolist(), word.tolist(), times.tolist(), context_n.tolist())) == [(5, 6, 2, 3), (5, 7, 1, 3), (6, 5, 2, 2), (7, 9, 1, 1), (9, 5, 1, 1)]
    assert len(low) == 5


def brute_components(rows, size=4, percent=85):
    sets = {}
    for d, t in rows:
        w = lowered(t)
        sets[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    name = {d: d for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and name[a] != name[b]:
                lo, hi = sorted((name[a], name[b]))
                name = {d: lo if c == hi else c for d, c in name.items()}
    return {d: (len(sets[d]), name[d]) for d in sets}


def check_components(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit("clash"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(docs).collect()}
    assert got == brute_components(rows)


def test_similar_components(spark, documents):
    check_components(spark, [(r.doc_id, r.text) for r in documents.collect()])


def test_similar_components_of_many_near_copies(spark, monkeypatch):
    """Chains and stars of near copies around the threshold, with tiles so small that groups are cut into many."""
    monkeypatch.setattr(jaccard, "TILE", 4)
    rng = np.random.default_rng(4)
    rows, shared = [], " ".join(f"p{i}" for i in range(60))
    for g in range(12):
        words = [f"g{g}w{i}" for i in range(int(rng.integers(30, 90)))]
        for _ in range(9):
            copy = [w if rng.random() > rng.choice([0, 0.02, 0.04, 0.06]) else f"x{rng.integers(10**9)}" for w in words]
            rows.append((len(rows) * 3, " ".join(copy)))
    rows += [(1000 + i, f"q{i} r{i} s{i} t{i} {shared}") for i in range(8)]
    rows += [(2000, None), (2001, ""), (2002, "one two"), (2003, "ONE  two"), (2004, "one"), (2005, "one two three four"), (2006, "\x0b")]
    check_components(spark, rows)


def test_similar_components_of_repeated_rows(spark, monkeypatch):
    """Every row twice, and similar pairs on both sides of a size band that share a tile and are no hubs of one another."""
    seen = []
    whole = jaccard.tiles
    monkeypatch.setattr(jaccard, "tiles", lambda rows, *a: seen.append(rows.groupBy("token", "id", "set").count().where("count > 1").count()) or whole(rows, *a))
    edge = math.ceil((100 / 85) ** 30)  # shingles from which a band starts
    rows = []
    for g in range(6):
        words = [f"g{g}w{i}" for i in range(edge + 8)]
        rows += [(10 * g + 1, " ".join(words)), (10 * g + 2, " ".join(words[: edge - 2]))]
    docs = spark.createDataFrame(rows * 2, DOCS)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_components(docs).collect()]
    want = brute_components(rows)
    assert sorted(got) == sorted((d, n, c) for d, (n, c) in want.items() for _ in range(2))
    assert len({c for _, c in want.values()}) == 6 and seen == [0]


def test_components_of_a_graph(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(100 + i, 101 + i) for i in range(20)] + [(200, 200 + i) for i in range(1, 30)]
    name = {x: x for e in edges if e[0] != e[1] for x in e}
    for a, b in edges * 25:
        if a != b:
            name[a] = name[b] = min(name[a], name[b])
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == name
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_packing(rows, pieces):
    """``pieces``: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    want = []
    for d, t in rows:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want += [(d, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    assert sorted(p[:5] for p in pieces) == sorted(want)
    sequences = {}
    for *_, length, _, sequence, offset in pieces:
        sequences.setdefault(sequence, []).append((offset, length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences)


def test_packing(spark, sf, documents):
    rows = [tuple(r) for r in queries.op6_best_fit_packing(spark, sf).collect()]
    count = check_packing([(r.doc_id, r.text) for r in documents.collect()], rows)
    assert count <= -(-sum(r[3] for r in rows) // 2048) * 1.02 + 1
    odd = [(1, None), (2, ""), (2, ""), (3, "word " * 5000), (4, "<|endoftext|> é😀"), (5, "a" * 9000)]
    check_packing(odd, [tuple(r) for r in queries.packed(spark.createDataFrame(odd, DOCS).withColumn("length", F.lit(1)).repartition(5)).collect()])
    assert queries.packed(spark.createDataFrame([], DOCS)).count() == 0


def test_best_fit():
    rng = np.random.default_rng(6)
    lengths = rng.integers(1, 101, 500)
    bins, offsets = packing.best_fit(lengths, 100)
    for b in set(bins.tolist()):
        parts = sorted(zip(offsets[bins == b].tolist(), lengths[bins == b].tolist(), strict=True))
        assert [o for o, _ in parts] == np.r_[0, np.cumsum([n for _, n in parts])[:-1]].tolist() and sum(n for _, n in parts) <= 100
    assert len(set(bins.tolist())) <= 1.1 * lengths.sum() / 100 + 1


def test_nearest_codes(spark, sf):
    got = queries.op7_multi_index_hamming(spark, sf).collect()
    rows = hamming.sign_codes(spark.read.parquet(f"{sf}/embeddings.parquet")).collect()
    check_nearest(got, rows, [r.vec_id for r in rows if r.vec_id % 20 == 0], 10)


def check_nearest(got, rows, asked, k):
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.distance, r.vec_id))
    code = {r.vec_id: r.code for r in rows}
    for q in asked:
        assert found[q] == sorted(((code[q] ^ r.code) & (1 << 64) - 1).bit_count() and (((code[q] ^ r.code) & (1 << 64) - 1).bit_count(), r.vec_id) or (0, r.vec_id) for r in rows)[:k]


def test_nearest_with_copies_and_few_rows(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(-(2**63), 2**63 - 1, 6)
    rows = [(i, int(base[0])) for i in range(40)] + [(100 + i, int(base[i % 6] ^ np.int64(i))) for i in range(30)]
    codes = spark.createDataFrame([*rows, (None, 5), (500, None)], "vec_id long, code long")
    asked = codes.where("vec_id % 20 = 0")
    check_nearest(hamming.nearest(codes, asked, 5).collect(), codes.where("vec_id IS NOT NULL AND code IS NOT NULL").collect(), [0, 20, 100, 120], 5)
    few = spark.createDataFrame([(1, 0), (2, -1)], "vec_id long, code long")
    assert [tuple(r) for r in hamming.nearest(few, few, 10).orderBy("query_id", "rank").collect()] == [(1, 1, 1, 0), (1, 2, 2, 64), (2, 1, 2, 0), (2, 2, 1, 64)]
    assert hamming.nearest(few.limit(0), few, 3).count() == 0 == hamming.nearest(few, few.limit(0), 3).count()
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 1.0])], "vec_id long, embedding array<float>")
    assert [r.code for r in hamming.sign_codes(odd).orderBy("vec_id").collect()][:2] == [0, 0]


def test_resharding(spark, sf, documents, tmp_path):
    got = queries.op8_flow_resharding(spark, sf).toPandas().set_index("doc_id")
    texts = {r.doc_id: (r.text or "").encode() for r in documents.collect()}
    assert all(r.size == len(texts[d]) + 1 and r.text_crc32 == zlib.crc32(texts[d]) for d, r in zip(got.index, got.rename(columns={"size": "bytes"}).assign(size=got["size"]).itertuples(), strict=True))
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= got["size"].max()
    for _, slots in got.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))
    old = got.groupby("old_shard")["size"].sum()
    least = sum(max(0, s - got["size"].sum() // 16) for s in old)
    assert got[got.old_shard != got.shard]["size"].sum() <= least + 12 * got["size"].max()
    blocked = resharding.with_blocks(documents, F.xxhash64("source"), 12)
    placed = resharding.reshard(blocked, [1] * 16, 12)
    folder = str(tmp_path / "shards")
    resharding.write_shards(placed, folder)
    assert spark.read.parquet(folder).groupBy("shard").count().count() == 16
    resharding.write_shards(placed, folder, [3])
    assert spark.read.parquet(folder).count() == documents.count()
    assert set(resharding.affected(placed, 12, 16)) <= set(range(16))
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (1, "x")], DOCS)
    assert resharding.reshard(resharding.with_blocks(odd, F.lit(0), 2), [1, 1], 2).count() == 4
    assert resharding.reshard(resharding.with_blocks(odd.limit(0), F.lit(0), 2), [1, 1], 2).count() == 0


@pytest.mark.parametrize("ids", ["none", "half under one", "all equal"])
def test_resharding_spreads_rows_of_one_id(spark, ids):
    one = {"none": "CAST(NULL AS LONG)", "half under one": "IF(id % 2 = 0, 7, id)", "all equal": "1"}[ids]
    text = "'the same'" if ids == "all equal" else "repeat('x', CAST(id % 97 AS INT))"
    docs = spark.range(20_000).selectExpr(f"{one} AS doc_id", f"{text} AS text", "'a' AS nr", "'b' AS before", "'c' AS shard", "'d' AS slot", "'e' AS block", "'f' AS size", "'g' AS old_shard")
    placed = resharding.reshard(resharding.with_blocks(docs, F.lit(0), 2), [1] * 16, 2)
    assert {"nr", "before"} <= set(placed.columns) and placed.where("nr = 'a' AND before = 'b'").count() == 20_000
    rows = placed.select("shard", "slot", "size").toPandas()
    sizes = rows.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 0.02 * sizes.sum() / 16 + 2 * rows["size"].sum() / 1024
    for _, slots in rows.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))


def test_resharding_writes_the_texts_and_plans_growth(spark, tmp_path):
    rows = [(i % 300 or None, "xyz"[i % 3] * (i * 37 % 501) if i % 50 else None, "abcde"[min(i % 7, 4)]) for i in range(3000)]
    spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, source string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    told = queries.op8_flow_resharding(spark, str(tmp_path))
    files = told.inputFiles()
    assert {f.rpartition("/")[0].rpartition("/")[2] for f in files} == {f"shard={j}" for j in range(16)}
    held = spark.read.parquet(files[0].rpartition("/shard=")[0])
    assert sorted(((r.doc_id, r.text) for r in held.collect()), key=repr) == sorted((r[:2] for r in rows), key=repr)
    got = told.toPandas()
    assert sorted(zip(got["size"], got.text_crc32, strict=True)) == sorted((len(t or "") + 1, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    for _, slots in got.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))
    total, grown = got["size"].sum(), got.groupby("grown_shard")["size"].sum()
    assert len(grown) == 20 and grown.max() - grown.min() <= 2 * got["size"].max()
    assert got[got.grown_shard != got["shard"]]["size"].sum() <= total / 5 + 16 * got["size"].max()
    assert told.schema["grown_shard"].dataType == told.schema["shard"].dataType
    spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert queries.op8_flow_resharding(spark, str(tmp_path / "none")).count() == 0


def test_resharding_shuffles_rows_once(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "repeat('x', CAST(id % 97 AS INT)) AS text", "'a' AS file", "'b' AS grown_shard")
    placed = resharding.reshard(resharding.with_blocks(docs, F.lit(0), 2), [1] * 4, 2)
    assert placed.where("file = 'a' AND grown_shard = 'b'").count() == 500
    assert placed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_min_cost_flow():
    rng = np.random.default_rng(9)
    for _ in range(20):
        n, m = rng.integers(1, 5, 2)
        supply = rng.integers(0, 6, n).tolist()
        capacity = np.bincount(rng.integers(0, m, sum(supply)), minlength=m).tolist()
        price = rng.integers(0, 5, (n, m))
        flow = np.array(resharding.min_cost_flow(supply, capacity, lambda i, j: int(price[i, j]))).reshape(n, m)  # noqa: B023
        assert flow.sum(1).tolist() == supply and flow.sum(0).tolist() == capacity and (flow >= 0).all()
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        best = {tuple(capacity): 0}
        for i in units:
            step = {}
            for left, cost in best.items():
                for j in range(m):
                    if left[j]:
                        key = tuple(x - (k == j) for k, x in enumerate(left))
                        step[key] = min(step.get(key, 10**9), cost + int(price[i, j]))
            best = step
        assert int((flow * price).sum()) == min(best.values())


def test_pipeline(spark, sf, documents):
    docs, columns = documents, documents.columns
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        out = corpus_pipeline.stage(step(spark, docs, sf), "test")
        kept[name] = {r.doc_id for r in out.select("doc_id").collect()}
        if name != "best-fit packing":
            assert out.columns == columns and out.count() == len(kept[name])
            docs, before = out, docs
        if name == "n-gram Jaccard join":
            groups = brute_components([(r.doc_id, r.text) for r in before.collect()])
            assert kept[name] == {d for d, (_, c) in groups.items() if d == c}
        if name == "benchmark decontamination":
            items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert not any(i in " ".join(r.text.split()) for i in items for r in docs.collect())
        if name == "secret scans":
            assert kept[name] == {r.doc_id for r in before.collect()}
            assert not docs.where("text RLIKE 'AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}' OR n_chars <> length(text)").count()
    assert kept["best-fit packing"] == kept["secret scans"]
    check_packing([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in out.collect()])
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "12", "en", "s", 2)], documents.schema)
    for rows in (odd, odd.limit(0)):
        for _, step in corpus_pipeline.STAGES:
            step(spark, rows, sf).count()


def test_pipeline_keeps_columns_of_any_name(spark, sf, documents):
    names = ["score", "margin", "lang_pred", "rejected", "base", "spans", "held", "key", "_key", "component_id", "first", "nr", "bin", "__text", "__0", "terms", "lot"]
    few = documents.where("doc_id % 3 = 0")
    docs = corpus_pipeline.stage(few.select("*", *[F.lit(n).alias(n) for n in names]), "test")
    plain = corpus_pipeline.stage(few, "test")
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs, plain = (corpus_pipeline.stage(step(spark, d, sf), "test") for d in (docs, plain))
        assert docs.columns == [*documents.columns, *names], name
        assert sorted(docs.select(*documents.columns).collect(), key=str) == sorted(plain.collect(), key=str), name
        assert docs.where(" AND ".join(f"`{n}` = '{n}'" for n in names)).count() == docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() > 0


def test_pipeline_rows_without_or_with_repeated_ids(spark, sf, documents):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 60").orderBy("item_id").first().text
    texts = [" ".join(f"{c}{i}" for i in range(50)) for c in "abcdefg"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1] + " z"), (None, f"{texts[2]} {item} {texts[2]}"), (4, texts[3]), (4, texts[4]), (5, texts[5]), (6, texts[5]), (8, texts[6])]
    steps = dict(corpus_pipeline.STAGES)
    for again, without in ((1, False), (2, False), (1, True)):
        used = [r for r in rows if not without or r[0] != 4] * again  # without repeated ids, plain ones are the keys
        docs = corpus_pipeline.stage(spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in used], documents.schema), "test")
        one = corpus_pipeline.stage(steps["n-gram Jaccard join"](spark, docs, sf), "test")
        got = [(r.doc_id, r.text) for r in one.collect()]
        left = [r for r in rows if r[0] != 6 and (not without or r[0] != 4)]
        assert one.columns == documents.columns and len(got) == len(set(got)) == len(left) - 1
        assert set(got) | {rows[1], rows[2]} == set(left) and len(set(got) & {rows[1], rows[2]}) == 1
        clean = [(r.doc_id, r.text) for r in steps["benchmark decontamination"](spark, one, sf).collect()]
        assert sorted(clean, key=str) == sorted([r for r in got if item not in r[1]], key=str) and len(clean) == len(got) - 1
