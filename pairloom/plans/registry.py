"""One query per operator, over inputs derived from the given tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairloom.functions import naming, paths
from pairloom.functions.text import casefold, nfc
from pairloom.operators import explore, saved_index, shards, slices, verify
from pairloom.operators import pairs as pair_ops
from pairloom.operators import resolve as res
from pairloom.operators.audit import audit_examples, audit_stats, audited_pairs
from pairloom.plans import flows
from pairloom.plans import inputs as src
from pairloom.plans.schedule import Slice
from pairloom.plans.schedule import slice_archives as archives_of
from pairloom.runtime import new_folder, stage
from pairloom.sources import archives, images, pair_files
from pairloom.sources.listing import list_tree, match_globs
from pairloom.sources.tree_source import tree_files
from pairloom.streaming.arrivals import ingest_archives, landed_archives
from pairloom.streaming.ingest import ingest_slices, published

QUERIES: dict = {}

GLOBS = [
    "Singleturn/results_add/*/original.png",
    "./singleturn/RESULTS_hybrid*/d?/*.PNG",
    "Singleturn/part1/d[!1-8]*",
    "pages/*/de/[0-4]*",
    "nothing/*.tar",
]
RULES = [("results_", "task_"), ("e", "E"), ("", "x"), ("original", "")]
MIN_RATE = 0.8
SHARD = 100


def query(f):
    QUERIES[f.__name__.rstrip("_")] = f
    return f


# Sources


@query
def scan_pairs(spark: SparkSession, sf: str) -> DataFrame:
    files = pair_files.list_pair_files(src.pair_file_tree(spark, sf))
    rows, _ = pair_files.scan_pairs(spark, pair_files.column_catalog(spark, files))
    return rows.selectExpr("file", "size(pairs) AS n_pairs", "get(pairs, 0).input_path AS input_path", "IF(size(pairs) > 0, prompts[0], NULL) AS prompt")


@query
def filter_files(spark: SparkSession, sf: str) -> DataFrame:
    files = pair_files.list_pair_files(src.pair_file_tree(spark, sf), only="add_part1.parquet, hybrid_part2.parquet")
    rows, _ = pair_files.scan_pairs(spark, pair_files.column_catalog(spark, files))
    return rows.groupBy("file").agg(F.count("*").alias("rows"), F.sum(F.size("pairs")).alias("pairs"))


@query
def profile_files(spark: SparkSession, sf: str) -> DataFrame:
    files = pair_files.list_pair_files(src.pair_file_tree(spark, sf))
    profile = pair_files.profile_files(pair_files.column_catalog(spark, files))
    names = F.concat_ws(",", "names").alias("names")
    return profile.select("file", "rows", "columns", names, F.concat_ws(",", "types").alias("types"), "layout", "input_col", "output_col", "text_col")


@query
def classify_schema(spark: SparkSession, sf: str) -> DataFrame:
    return pair_files.classify_schema(src.column_catalog(spark, sf))


@query
def file_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Tree on disk, walked in tasks; empty and unfinished files are listed too."""
    tree = list_tree(spark, src.image_tree(spark, sf))
    return res.file_manifest(tree).select("path", (F.col("size") > 0).alias("has_bytes"))


@query
def slice_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of two slices' folders; the listing opens no other folder."""
    under = ["Singleturn/results_add/", "Singleturn/part1/"]
    return tree_files(spark, src.image_tree(spark, sf), under, levels=2).select("path", (F.col("size") > 0).alias("has_bytes"))


@query
def match_globs_(spark: SparkSession, sf: str) -> DataFrame:
    return match_globs(src.file_listing(spark, sf), GLOBS)


@query
def check_split_parts(spark: SparkSession, sf: str) -> DataFrame:
    return archives.check_split_parts(archives.split_parts(src.split_listing(spark, sf)))


@query
def scan_tar_members(spark: SparkSession, sf: str) -> DataFrame:
    """Shards cut into parts, indexed by several tasks each and read back."""
    root = src.split_shards(spark, sf)
    found = archives.list_archives(list_tree(spark, root))
    members = archives.scan_tar_members(found, root, range_bytes=64 << 10)
    text = F.when(F.col("member").endswith(".txt"), F.decode("payload", "UTF-8"))
    return members.select(
        "archive", "member", text.alias("text"), (F.length("payload") == F.col("size")).alias("whole")
    )


@query
def scan_image_bytes(spark: SparkSession, sf: str) -> DataFrame:
    root = src.image_tree(spark, sf)
    data = images.scan_image_bytes(src.located_manifest(src.files_on_disk(spark, sf)), root)
    # Signature, width and height of a PNG lie at fixed places.
    def number(at):
        return F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("int")

    return data.select("path", number(17).alias("width"), number(21).alias("height"), F.col("content").isNull().alias("is_missing"))


# Pair extraction


@query
def flatten_paths(spark: SparkSession, sf: str) -> DataFrame:
    df = src.list_table(spark, sf)
    flat = pair_ops.flatten_paths("input_images", df.schema["input_images"].dataType)
    return df.selectExpr("file", "row_index", f"size({flat}) AS n", f"concat_ws('|', {flat}) AS flat")


def _emitted(rows: DataFrame) -> DataFrame:
    return pair_ops.emit_pairs(rows).drop("part")


@query
def pairs_from_lists(spark: SparkSession, sf: str) -> DataFrame:
    return _emitted(src.list_rows(spark, sf))


@query
def pairs_from_turns(spark: SparkSession, sf: str) -> DataFrame:
    return _emitted(src.turn_rows(spark, sf))


@query
def pairs_from_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _emitted(src.column_rows(spark, sf))


@query
def clean_prompt(spark: SparkSession, sf: str) -> DataFrame:
    raw = r"concat(' \t\u3000', prompt, '\u2028\n')"
    return src.pairs_base(spark, sf).selectExpr("row_index", f"{pair_ops.clean_prompt(raw)} AS prompt")


@query
def emit_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _emitted(src.all_rows(spark, sf))


# Path functions


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    """Input paths in many spellings."""
    return src.pairs_base(spark, sf).selectExpr(
        "row_index",
        """CASE row_index % 6 WHEN 0 THEN concat('  /.//', in_path, char(9)) WHEN 1 THEN replace(in_path, '/', '\\\\')
           WHEN 2 THEN concat('MultiTurn//singleturn/', in_path) WHEN 3 THEN concat('cafe', '\\u0301/', in_path)
           WHEN 4 THEN concat('./', in_path) ELSE in_path END AS path""",
        "prompt",
    )


@query
def normalize_path(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).selectExpr("row_index", f"{paths.normalize_path('path')} AS path")


@query
def path_variants(spark: SparkSession, sf: str) -> DataFrame:
    variants = paths.path_variants("path")
    return _paths(spark, sf).selectExpr("row_index", f"posexplode({variants}) AS (nth, variant)")


@query
def substitute_paths(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).selectExpr("row_index", f"{paths.substitute_paths('path', RULES)} AS path")


@query
def slice_rules(spark: SparkSession, sf: str) -> DataFrame:
    settings = slices.PathSettings(rules=[("a", "b")], hybrid_stems=["add_part3"])
    rules = slices.slice_rules(naming.stem_of("file"), settings)
    return src.pairs_base(spark, sf).selectExpr("file", "row_index", f"inline({rules})")


@query
def prepend_subdir(spark: SparkSession, sf: str) -> DataFrame:
    path = paths.prepend_subdir("path", "' Singleturn//part1/ '")
    return _paths(spark, sf).selectExpr("row_index", f"{path} AS path")


@query
def root_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).selectExpr("row_index", f"{paths.root_prefix('path')} AS root")


@query
def is_basename_only(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).selectExpr("row_index", f"{paths.is_basename_only('path')} AS bare")


@query
def null_path(spark: SparkSession, sf: str) -> DataFrame:
    word = r"CASE row_index % 4 WHEN 0 THEN ' None' WHEN 1 THEN 'NULL\n' WHEN 2 THEN concat(' ', path) ELSE '  ' END"
    words = _paths(spark, sf).selectExpr("row_index", f"{word} AS word")
    return words.selectExpr("row_index", f"{paths.null_path('word')} AS path")


@query
def fold_text(spark: SparkSession, sf: str) -> DataFrame:
    """Normal form and case folding of whole texts."""
    docs = src.table(spark, sf, "documents")
    return docs.selectExpr("doc_id", f"{nfc('text')} AS nfc", f"{casefold('text')} AS folded")


@query
def sample_key(spark: SparkSession, sf: str) -> DataFrame:
    key = naming.sample_key(naming.stem_of("file"), "row_index", "coalesce(prompt, '')")
    return src.pairs_base(spark, sf).selectExpr("row_index", f"{key} AS key")


@query
def shard_name(spark: SparkSession, sf: str) -> DataFrame:
    prefix = "CASE WHEN row_index % 2 = 0 THEN concat(' ', replace(file, '.parquet', '')) ELSE ' ' END"
    return src.pairs_base(spark, sf).selectExpr("row_index", f"{naming.shard_name('row_index * 37', prefix)} AS name")


@query
def slice_layout(spark: SparkSession, sf: str) -> DataFrame:
    folder = naming.slice_layout("out/", naming.stem_of("file"))
    return src.pairs_base(spark, sf).groupBy(F.expr(folder).alias("folder")).agg(F.count("*").alias("rows"))


# Resolution


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return slices.rewrite_pairs(pair_ops.emit_pairs(src.list_rows(spark, sf)), src.SETTINGS)


def _refs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = pair_ops.emit_pairs(src.list_rows(spark, sf), prompts=False)
    return res.reference_paths(slices.rewrite_pairs(pairs, src.SETTINGS))


@query
def resolve_exact(spark: SparkSession, sf: str) -> DataFrame:
    """References whose first hit has the spelling asked for."""
    refs = _refs(spark, sf)
    found = res.resolve_paths(refs, src.files_on_disk(spark, sf), sibling=False)
    same = F.substring_index("ref", "/", -1) == F.substring_index("path", "/", -1)
    return found.filter(same).select("ref", "path")


@query
def resolve_casefold(spark: SparkSession, sf: str) -> DataFrame:
    """References whose first hit differs in case."""
    refs = _refs(spark, sf)
    found = res.resolve_paths(refs, src.files_on_disk(spark, sf), sibling=False)
    same = F.substring_index("ref", "/", -1) == F.substring_index("path", "/", -1)
    return found.filter(~same).select("ref", "path")


@query
def resolve_sibling(spark: SparkSession, sf: str) -> DataFrame:
    """References found only under another task folder."""
    refs = _refs(spark, sf)
    found = res.resolve_paths(refs, src.files_on_disk(spark, sf))
    return found.filter(F.col("rank") >= res.SIBLING_BASE).select("ref", "path")


@query
def resolve_paths(spark: SparkSession, sf: str) -> DataFrame:
    refs = _refs(spark, sf)
    found = res.resolve_paths(refs, src.files_on_disk(spark, sf))
    return refs.select("ref").join(found.select("ref", "path", "size"), "ref", "left")


@query
def resolve_paths_saved(spark: SparkSession, sf: str) -> DataFrame:
    """The same over an index that was saved before, joined bucket by bucket."""
    folder = src.once(spark, sf, "index", lambda f: saved_index.save_index(src.files_on_disk(spark, sf), f, buckets=8))
    refs = _refs(spark, sf)
    found = res.resolve_paths(refs, saved_index.open_index(spark, folder))
    return refs.select("ref").join(found.select("ref", "path", "size"), "ref", "left")


@query
def resolve_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _pairs(spark, sf)
    refs = stage(_refs(spark, sf), "references")
    found = stage(res.resolve_paths(refs, src.files_on_disk(spark, sf)), "resolved")
    both = res.resolve_pairs(pairs, found.select("ref", "path"), refs)
    return both.select("file", "row_index", "turn_pos", "input_found", "output_found")


@query
def missing_roots(spark: SparkSession, sf: str) -> DataFrame:
    histogram = explore.root_histogram(src.all_rows(spark, sf))
    return explore.missing_roots(histogram, src.file_listing(spark, sf))


# Reports


@query
def explore_stats(spark: SparkSession, sf: str) -> DataFrame:
    return explore.explore_stats(src.all_rows(spark, sf))


@query
def root_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return explore.root_histogram(src.all_rows(spark, sf))


@query
def explore_totals(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.all_rows(spark, sf)
    # Files that hold no rows of a known layout still count as files.
    extra = src.table(spark, sf, "supplier").selectExpr("concat('u', s_suppkey, '.parquet') AS file")
    return explore.explore_totals(explore.explore_stats(rows), rows.select("file").union(extra))


def _audited(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = src.list_rows(spark, sf)
    return rows, audited_pairs(rows, src.files_on_disk(spark, sf), src.SETTINGS)


@query
def audit_stats_(spark: SparkSession, sf: str) -> DataFrame:
    return audit_stats(*_audited(spark, sf))


@query
def audit_examples_(spark: SparkSession, sf: str) -> DataFrame:
    return audit_examples(_audited(spark, sf)[1], src.SETTINGS)


def _built(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _pairs(spark, sf)
    refs = stage(_refs(spark, sf), "references")
    known = stage(res.resolve_paths(refs, src.manifest(spark, sf).select("path", "size", "valid")), "resolved")
    return shards.build_status(res.resolve_pairs(pairs, known.select("ref", "size", "valid"), refs))


@query
def build_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.list_rows(spark, sf)
    return shards.build_stats(rows, _built(spark, sf)).drop("note")


@query
def slice_gate(spark: SparkSession, sf: str) -> DataFrame:
    return _verdicts(spark, sf).select("file", "verdict", "reason")


def _verdicts(spark: SparkSession, sf: str, failures: DataFrame | None = None) -> DataFrame:
    rows = src.list_rows(spark, sf)
    # Resolved once: a file that has a size exists.
    built = stage(_built(spark, sf), "built")
    audited = built.selectExpr("file", "input_size IS NOT NULL AS input_ok", "output_size IS NOT NULL AS output_ok")
    audit = audit_stats(rows, audited).withColumn(
        "layout", F.when(F.col("file").endswith("7.parquet"), "unknown").otherwise("lists")
    )
    build = shards.build_stats(rows, built)
    return slices.slice_gate(audit, build, min_rate=MIN_RATE, failures=failures)


@query
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Slices whose archives, those of the supplier and orders of their number, have gaps count as failed."""
    splits = stage(archives.check_split_parts(archives.split_parts(src.split_listing(spark, sf))), "splits")  # used twice
    files = src.list_rows(spark, sf).select("file").distinct()
    numbered = files.selectExpr("file", "regexp_extract(file, '([0-9]+)[.]parquet$', 1) AS number").filter("number <> ''")
    owned = splits.selectExpr("concat(dir, base) AS archive", "base", "regexp_extract(dir, 's([0-9]+)/$', 1) AS number")
    needed = numbered.join(owned, "number").filter("startswith(base, concat('a', number))").select("file", "archive")
    return slices.run_summary(_verdicts(spark, sf, slices.slice_failures(needed, splits, files)))


# Numbers and shards


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    kept = _built(spark, sf).filter(F.col("status") == shards.KEPT)
    return kept.select("file", "part", "row_index", "turn_pos", "prompt")


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    return shards.assign_shards(shards.pair_index(_kept(spark, sf)), SHARD)


@query
def pair_index(spark: SparkSession, sf: str) -> DataFrame:
    numbered = shards.pair_index(_kept(spark, sf))
    return numbered.select("file", "row_index", "turn_pos", "pair_index")


@query
def pair_index_per_file(spark: SparkSession, sf: str) -> DataFrame:
    numbered = shards.pair_index(_kept(spark, sf), per_file=True)
    return numbered.select("file", "row_index", "turn_pos", "pair_index")


@query
def assign_shards(spark: SparkSession, sf: str) -> DataFrame:
    return _samples(spark, sf).select("key", "pair_index", "shard_id", "shard_name")


@query
def limit_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Build counts of the part read before three shards are full."""
    built = stage(_built(spark, sf), "built")
    numbered = shards.pair_index(built.filter(F.col("status") == shards.KEPT), staged=False)
    return shards.limited_stats(src.list_rows(spark, sf), built, numbered, 3, SHARD).drop("note")


@query
def build_first_shards(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts by a build that stops: images are decoded only as far as three shards need them."""
    rows, manifest = src.list_rows(spark, sf), src.located_manifest(src.files_on_disk(spark, sf))
    root, enough = src.image_tree(spark, sf), 3 * SHARD
    built = flows.first_pairs(rows, manifest, src.SETTINGS, root, enough)
    numbered = shards.pair_index(built.filter(F.col("status") == shards.KEPT), staged=False)
    return shards.limited_stats(rows, built, numbered, 3, SHARD).drop("note")


@query
def skip_existing(spark: SparkSession, sf: str) -> DataFrame:
    samples = _samples(spark, sf)
    # Every shard with an odd number is taken to exist already.
    odd = naming.shard_name("o_orderkey * 2 + 1")
    existing = src.table(spark, sf, "orders").selectExpr(f"{odd} AS shard_name")
    return shards.skip_existing(samples, existing).select("key", "shard_name")


@query
def verify_shards(spark: SparkSession, sf: str) -> DataFrame:
    samples = stage(_samples(spark, sf), "samples")
    checked = verify.verify_shards(src.shard_members(samples), shards.shard_sizes(samples))
    return checked.withColumn("examples", F.concat_ws(",", "examples"))


# Images, shards on disk and streaming


@query
def image_validity(spark: SparkSession, sf: str) -> DataFrame:
    root = src.image_tree(spark, sf)
    return images.image_validity(src.located_manifest(src.files_on_disk(spark, sf)), root).drop("checked_by")


@query
def image_validity_jvm(spark: SparkSession, sf: str) -> DataFrame:
    """The same by Spark's image source, which does not list empty files."""
    root = src.image_tree(spark, sf)
    found = images.decode_folder(spark, root)
    return found.withColumn("path", F.regexp_replace("path", "^.*/(?=Singleturn/)", "")).drop("checked_by")


@query
def image_validity_archived(spark: SparkSession, sf: str) -> DataFrame:
    """JPEGs inside tars: no file to read for the image source, so their scans are walked."""
    root = src.picture_archives(spark, sf)
    index = archives.index_archives(archives.list_archives(list_tree(spark, root)), root)
    checked = images.image_validity(archives.archive_manifest(index), root)
    return checked.select(F.regexp_extract("path", "([0-9]+)[.]jpg$", 1).cast("long").alias("doc_id"), "valid", "width", "height", "checked_by")


@query
def image_fit(spark: SparkSession, sf: str) -> DataFrame:
    checked = QUERIES["image_validity"](spark, sf).filter("valid")
    width, height = images.image_fit("width", "height")
    return checked.selectExpr("path", f"{width} AS width", f"{height} AS height")


@query
def write_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Members of the written shards, in the order they lie in each tar."""
    out = src.written_shards(spark, sf)
    members = archives.index_members(archives.list_archives(list_tree(spark, out)), out)
    nth = F.row_number().over(W.partitionBy("archive").orderBy("offset"))
    return members.select(F.col("archive").alias("shard_name"), nth.alias("nth"), "member")


@query
def verify_decode(spark: SparkSession, sf: str) -> DataFrame:
    members = flows.shard_members(spark, src.written_shards(spark, sf))
    return flows.verify_decode(members.filter("state = 'file'"))


@query
def slice_archives(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [Slice("add_part0", GLOBS[0]), Slice("hybrid_part2", GLOBS[1])]
    return archives_of(spark, src.file_listing(spark, sf), wanted)


@query
def write_reports(spark: SparkSession, sf: str) -> DataFrame:
    """The audit report, written as JSON and read back."""
    rows, audited = _audited(spark, sf)
    out = new_folder(spark, "reports")
    stats = audit_stats(rows, audited)
    flows.write_reports({"audit": stats}, out)
    return spark.read.schema(stats.schema).json(f"{out}/audit")


@query
def ingest_slices_(spark: SparkSession, sf: str) -> DataFrame:
    """All pair files through the stream; kept samples and verdict per slice."""
    root, out = src.pair_file_tree(spark, sf), new_folder(spark, "ingest")
    schema = src.list_table(spark, sf).drop("file", "part").schema
    stream = ingest_slices(
        spark,
        f"{root}/Parquet",
        schema,
        "lists",
        lambda: src.files_on_disk(spark, sf),
        out,
        new_folder(spark, "offsets"),
        settings=src.SETTINGS,
        min_rate=MIN_RATE,
        files_per_batch=3,
        root=src.image_tree(spark, sf),
    )
    stream.awaitTermination()
    verdicts = published(spark, out, "verdicts").select("file", "strict_pairs", "verdict", "reason")
    samples = published(spark, out, "samples").groupBy("file").agg(
        F.count("*").alias("samples"), F.max("pair_index").alias("last_index")
    )
    return verdicts.join(samples, "file", "left")


@query
def split_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Archives whose parts come in three batches; those that lack a part at the end are not released."""
    listing, out, there = stage(src.order_parts(spark, sf), "listing"), new_folder(spark, "archives"), new_folder(spark, "arrivals")
    listing.filter("NOT lost").select("path", "size").repartition(8, F.xxhash64("path")).write.parquet(there)
    arrivals = spark.readStream.schema("path string, size long").option("maxFilesPerTrigger", 3).parquet(there)
    ingest_archives(spark, arrivals, listing.select("path", "size"), out, new_folder(spark, "offsets"))
    parts = F.expr("aggregate(parts, 0L, (n, p) -> n + p.size)").alias("bytes")
    return landed_archives(spark, out).select("archive", F.size("parts").cast("long").alias("parts"), parts)
