"""The thirteen operators over whole tables, and the pipeline."""

import zlib

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import collocations, decontaminate, hamming, html_tree, jaccard, language, lm_trie, packing, resharding, runs, secret_scan, stable_tree, toxicity
from pairloom.runtime import new_folder, stage

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
OLD_SHARDS, NEW_SHARDS, GROWN_SHARDS = 12, 16, 20


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(folds: int) -> Column:
    """Remainder of crc32 of doc_id as text; 0 for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds, F.lit(0))


@query
def op1_elias_fano_lm(spark: SparkSession, sf: str) -> DataFrame:
    scored, _ = lm_trie.score(table(spark, sf, "documents"), fold(5) != 1, keep_model=False)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op2_latent_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Only documents that hold an item have rows, one an item."""
    return decontaminate.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op3_zstd_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.learn(docs.where(fold(4) != 2))
    return language.identify(docs.withColumn("held_out", fold(4) == 2), model, ["doc_id", "held_out"])


@query
def op4_tree_html(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return html_tree.extract(pages, html_tree.learn(pages), ["page_id", "url"])


@query
def op5_jaccard_tiles(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    placed = packing.pack_documents(docs, RANKS, keep=[F.crc32("ids").alias("ids_crc32")])
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op6_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packed(table(spark, sf, "documents"))


@query
def op7_multi_index_hamming(spark: SparkSession, sf: str) -> DataFrame:
    """Queries: every vector whose id is divisible by 20; the vector itself is among its neighbours."""
    codes = stage(hamming.sign_codes(table(spark, sf, "embeddings")), "codes")
    return hamming.nearest(codes, codes.where("vec_id % 20 = 0"))


@query
def op8_flow_resharding(spark: SparkSession, sf: str) -> DataFrame:
    """Old shards hold whole sources, so that one of them is far too large. Rows tell what the written shards hold; grown_shard: after as much growth again."""
    docs = resharding.with_blocks(table(spark, sf, "documents").select("doc_id", "text", "source"), F.xxhash64("source"), OLD_SHARDS)
    docs = docs.selectExpr("doc_id", "text", "size", "crc32(coalesce(text, '')) AS text_crc32", "old_shard", "block")
    placed = resharding.reshard(docs, [1] * NEW_SHARDS, OLD_SHARDS, ["doc_id", "text_crc32", "size"], [1] * GROWN_SHARDS)
    placed, folder = placed.drop("size", "text_crc32", "block"), new_folder(spark, "shards")
    resharding.write_shards(placed, folder)
    held = resharding.read_shards(placed, folder)
    told = ["CAST(coalesce(octet_length(text), 0) + 1 AS LONG) AS size", "crc32(coalesce(text, '')) AS text_crc32"]
    return held.selectExpr("doc_id", *told, "'bytes' AS law", "shard", "slot", "grown_shard", "old_shard")


@query
def op9_markov_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = secret_scan.find(docs.select("doc_id", "text"), secret_scan.learn(docs))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = {k})) AS LONG) AS n_{kind}") for k, kind in enumerate(secret_scan.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secret_scan.as_text("base"), 256).alias("base_sha256"), secret_scan.as_text("spans").alias("spans"))


@query
def op10_kneser_ney_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.learn(docs, table(spark, sf, "labels").where(fold(5) != 0), fold(5) == 4)
    scored = toxicity.score(docs.withColumn("held_out", fold(5) == 0), model, ["doc_id", "held_out"])
    return scored.selectExpr("doc_id", "held_out", "score", "CAST(score >= 0.5 AS INT) AS predicted", *toxicity.RATIOS)


@query
def op11_stable_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Queries: every vector whose id is divisible by 50; the vector itself is no neighbour."""
    vectors = table(spark, sf, "embeddings")
    return stable_tree.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def with_loop(row: dict, words: list) -> list:
    """Every tenth document's words go round in a loop from some place on, as its id's checksum says; a null id stays as it is."""
    h = zlib.crc32(str(row["doc_id"]).encode())
    if row["doc_id"] is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query
def op12_lyndon_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf, "documents"), ["doc_id"], edit=with_loop)
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length AS shorter, r.start AS start, r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    digests = [F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")]
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("r"), *digests)
    return told.selectExpr("doc_id", "n_runs", "r.start", "-r.shorter AS length", "r.period", "1000 * -r.shorter div r.period AS exponent_milli", "runs_sha256", "collapsed_sha256")


@query
def op13_son_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


@query
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


ORACLES["op5_jaccard_tiles"] = r"""
WITH RECURSIVE words AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
lists AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END AS s FROM words),
shingles AS (SELECT DISTINCT doc_id, unnest(s) AS s FROM lists),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS d, doc_id AS m FROM documents UNION SELECT b, m FROM reached JOIN edges ON a = d)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents LEFT JOIN sizes USING (doc_id)
JOIN (SELECT d AS doc_id, min(m) AS component_id FROM reached GROUP BY d) USING (doc_id)
"""

ORACLES["op13_son_collocations"] = r"""
WITH pieces AS (
 SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
phrases AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
 FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
counts AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS f FROM phrases GROUP BY lang, phrase HAVING count(*) >= 30),
sizes AS (SELECT lang, count(*) AS n FROM phrases WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
cuts AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS cut FROM candidates),
scores AS (SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, CAST(2000000 * CAST(c.a AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
 FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
 JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
weakest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (SELECT lang, a, w, k, part, unnest(range(1, k - part + 2)) AS i FROM candidates, (SELECT unnest([2, 3]) AS part) WHERE part < k),
around AS (SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(a) AS longer FROM parts GROUP BY ALL),
ranked AS (SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
 FROM weakest LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
