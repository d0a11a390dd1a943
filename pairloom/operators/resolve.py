"""Path resolution as one ranked-candidate join against a file manifest.

A reference is tried under several spellings, in several folders, exactly and
by folded name, and last under any sibling task folder. The folders are tried
from the manifest side: each listed file is indexed under its own path and
under its path inside every known folder, so a reference ships one or two
lookup rows instead of one per candidate. Exact and folded matches share one
key, because a candidate with an exact match also has a folded one.

    manifest (path, ...)  --file_index-->    (kind, key, in_0 .. in_3, task)
    refs (ref)            --path_lookups-->  (ref, kind, key, want, base, places)
    join on (kind, key), smallest rank per ref wins

``in_<place>`` is the smallest file name there that folds to the key, ``lo`` the one that wins. Where the spelling of
the winner matters, ``locate`` looks up the exact name first and uses ``lo``
only if there is none.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import text_literal
from pairloom.functions.paths import base_name, canonical_path, collapse_path, dir_name, path_variants
from pairloom.functions.text import casefold
from pairloom.operators.skew import SAMPLE, hot_keys, skew_left_join
from pairloom.runtime import stage

# Folders tried after the root itself, and the task folders of the last resort.
SINGLE, MULTI = "Singleturn", "Multiturn"
TASK = "r'^Singleturn/(results_[^/]*)/([^/]+/[^/]+)$'"
PAIR_DIR = "Parquet"

# References with one spelling only: printable ASCII, nothing to strip, collapse or cut off.
UNCLEAN = r"r'(?i)^(?:singleturn|multiturn)/|^[ ./]|[ /]$|//|/\.\.?(?:/|$)|\\|[^ -~]'"

# Places in the order they are tried for one spelling; the bare repeat has no PAIR_DIR.
ROOT, IN_SINGLE, IN_MULTI, IN_PAIRS = range(4)
PER_SPELLING = 7
SIBLING_BASE = 1000
DIRECT, SIBLING = 0, 1


def _folded(df: DataFrame) -> DataFrame:
    """Replace ``path`` by its lookup key and the file name as spelled."""
    rest = [c for c in df.columns if c != "path"]
    named = df.selectExpr(*rest, f"{dir_name('path')} AS dir", f"{base_name('path')} AS want")
    folded = named.selectExpr(*rest, "dir", "want", f"{casefold('want')} AS fold")
    return folded.selectExpr(*rest, "want", "concat(dir, fold) AS key")


def _folders(pair_dir: str) -> list[tuple[int, str]]:
    pairs = "/".join(s for s in pair_dir.split("/") if s not in ("", "."))
    return [(p, f) for p, f in ((IN_SINGLE, SINGLE), (IN_MULTI, MULTI), (IN_PAIRS, pairs)) if f]


def file_index(manifest: DataFrame, pair_dir: str = PAIR_DIR, sibling: bool = True) -> DataFrame:
    """Manifest keyed by every path under which a reference may name a file."""
    extra = [c for c in manifest.columns if c != "path"]

    def entry(kind, place, path, task="CAST(NULL AS STRING)"):
        return f"struct({kind} AS kind, {place} AS place, {path} AS path, {task} AS task)"

    entries = [entry(DIRECT, ROOT, "path")]
    for place, name in _folders(pair_dir):
        inside = entry(DIRECT, place, f"substring(path, {len(name) + 2})")
        entries.append(f"IF(startswith(path, '{name}/'), {inside}, NULL)")
    if sibling:
        task, tail = (f"regexp_extract(path, {TASK}, {i})" for i in (1, 2))
        entries.append(f"IF(path RLIKE {TASK}, {entry(SIBLING, ROOT, tail, task)}, NULL)")
    keyed = manifest.selectExpr(*extra, f"inline(array_compact(array({', '.join(entries)})))")
    # One row per key, so that the join needs no second shuffle of the manifest.
    file = f"struct({', '.join(['want', *extra])})"
    found = [F.expr(f"min(IF(place = {p}, {file}, NULL))").alias(f"in_{p}") for p in range(4)]
    tasks = [F.min("task").alias("task"), F.max("task").alias("last_task")]
    # A sibling counts only if exactly one task folder has it.
    return (
        _folded(keyed)
        .groupBy("kind", "key")
        .agg(*found, *tasks)
        .filter(f"kind = {DIRECT} OR task = last_task")
        .drop("last_task")
    )


def path_lookups(refs: DataFrame, pair_dir: str = PAIR_DIR, sibling: bool = True, root: str = "") -> DataFrame:
    """Lookup rows of each distinct reference, ranked in the order of trial."""

    def spelled(v: str) -> str:
        bare = canonical_path(f"trim(LEADING './' FROM {v})")
        tail = f"substring_index({collapse_path(v)}, '/', -2)"
        return f"struct({canonical_path(v)} AS path, {bare} AS bare, {tail} AS tail)"

    def entry(kind, path, base, places):
        return f"struct({kind} AS kind, {path} AS path, {base} AS base, {places} AS places)"

    # What starts with a slash is absolute; below the root it is a relative path that only the root itself may hold.
    below = text_literal(f"{root.rstrip('/')}/")
    plain = canonical_path("ref")
    own = f"IF({str(bool(root)).lower()} AND startswith({plain}, {below}), substring({plain}, char_length({below}) + 1), {plain})"
    as_is = f"struct({own} AS path, {own} AS bare, '' AS tail)"
    first = f"nth * {PER_SPELLING}"
    entries = [
        entry(DIRECT, "s.path", first, "IF(startswith(ref, '/'), 1, 4)"),
        # The repeat without leading dots is not tried next to the pair files.
        f"IF(s.bare <> s.path, {entry(DIRECT, 's.bare', f'{first} + 4', 3)}, NULL)",
    ]
    for place, name in _folders(pair_dir):
        # A spelling that climbs out of the root may come back in under a folder.
        back_in = entry(DIRECT, canonical_path(f"concat('{name}/', s.path)"), f"{first} + {place}", 1)
        entries.append(f"IF(startswith(s.path, '../'), {back_in}, NULL)")
    if sibling:
        usable = r"contains(s.tail, '/') AND NOT s.tail RLIKE r'(^|/)\.\.(/|$)' AND (nth = 0 OR s.tail <> tail)"
        entries.append(f"IF({usable}, {entry(SIBLING, 's.tail', f'nth + {SIBLING_BASE}', 1)}, NULL)")
    inside = "x IS NOT NULL AND x.path NOT IN ('', '..') AND NOT startswith(x.path, '../')"
    clean = "array(struct(ref AS path, ref AS bare, substring_index(ref, '/', -2) AS tail))"
    rows = (
        refs
        # Spellings that come to the same are tried once.
        .selectExpr(
            "ref",
            f"""CASE WHEN startswith(ref, '/') THEN array({as_is}) WHEN NOT ref RLIKE {UNCLEAN} THEN {clean}
                ELSE array_distinct(transform({path_variants('ref')}, v -> {spelled('v')})) END AS s""",
        )
        .selectExpr("ref", "s[0].tail AS tail", "posexplode(s) AS (nth, s)")
        .selectExpr("ref", f"inline(filter(array({', '.join(entries)}), x -> {inside}))")
    )
    return _folded(rows)


def match_lookups(
    lookups: DataFrame, index: DataFrame, hot: DataFrame, pair_dir: str = PAIR_DIR
) -> DataFrame:
    """First hit per reference, with the exact and the smallest folded spelling.

    Many references may share the tail by which siblings are found, so keys
    with many lookups are joined apart.
    """
    names = dict(_folders(pair_dir))
    in_task = f"concat('{SINGLE}/', task, '/')"
    tried = []
    for place in range(4):
        folder = f"'{names[place]}/'" if place in names else f"IF(kind = {SIBLING}, {in_task}, '')"
        hit = f"struct(base + {place} AS rank, {folder} AS folder, in_{place} AS lo)"
        tried.append(f"IF(places > {place} AND in_{place} IS NOT NULL, {hit}, NULL)")
    parent = f"concat(hit.folder, left(key, length(key) - length({base_name('key')})))"
    hits = skew_left_join(lookups, index, ["kind", "key"], hot, ["ref"])
    hits = hits.selectExpr("ref", "key", "want", f"coalesce({', '.join(tried)}) AS hit")
    return (
        hits.filter("hit IS NOT NULL")
        .selectExpr("ref", "hit.rank", f"{parent} AS parent", "want", "hit.lo")
        .selectExpr(
            "ref",
            "struct(rank, concat(parent, want) AS exact, concat(parent, lo.want) AS path, lo) AS hit",
        )
        .groupBy("ref")
        .agg(F.min("hit").alias("hit"))
    )


def resolve_paths(
    refs: DataFrame,
    manifest: DataFrame,
    pair_dir: str = PAIR_DIR,
    sibling: bool = True,
    locate: bool = True,
    root: str = "",
) -> DataFrame:
    """Resolved path per distinct reference; unresolved references are absent.

    An absolute reference resolves if it lies below ``root``, under its own name only.

    Paths in the manifest are canonical and unique, as ``file_manifest`` makes them.
    With ``locate`` the result carries the spelling on disk and the other
    manifest columns; without, only the fact that the reference resolves. A
    ``SavedIndex`` in place of the manifest spares its shuffles.
    """
    if "n" not in refs.columns:
        refs = _counted(refs)
    # Reading the count keeps this plan the same as that of the hot references.
    refs = refs.filter("n > 0").select("ref")
    extra = [c for c in manifest.columns if c != "path"] if locate else []
    if isinstance(manifest, DataFrame):
        index = file_index(manifest.select("path", *extra), pair_dir, sibling)
    else:
        if pair_dir != manifest.pair_dir:
            raise ValueError(f"the index was saved for {manifest.pair_dir!r}")
        index, manifest = manifest.entries, manifest.files
        if not sibling:
            index = index.filter(F.col("kind") == DIRECT)
    # Chosen by hash, so that every evaluation counts the same references, and written once.
    some = path_lookups(refs.filter(f"pmod(xxhash64(ref), {SAMPLE}) = 0"), pair_dir, sibling, root)
    some = some.groupBy("kind", "key").agg(F.count("*").alias("n"))
    hot = stage(hot_keys(some, ["kind", "key"], SAMPLE), "hot")
    hits = match_lookups(path_lookups(refs, pair_dir, sibling, root), index, hot, pair_dir)
    if not locate:
        return hits.select("ref")
    here = ", ".join(["true AS found", *extra])
    on_disk = manifest.selectExpr("path AS exact", f"struct({here}) AS here")
    return (
        hits.select("ref", "hit.*")
        .join(on_disk, "exact", "left")
        .selectExpr(
            "ref",
            "rank",
            "IF(here.found, exact, path) AS path",
            *[f"IF(here.found, here.{c}, lo.{c}) AS {c}" for c in extra],
        )
    )


def _counted(refs: DataFrame) -> DataFrame:
    return refs.filter("ref IS NOT NULL").groupBy("ref").agg(F.count("*").alias("n"))


def reference_paths(pairs: DataFrame) -> DataFrame:
    """Distinct references of both sides of all pairs, with the number of their uses."""
    return _counted(pairs.selectExpr("explode(array(input_ref, output_ref)) AS ref"))


def staged_references(pairs: DataFrame) -> DataFrame:
    """``reference_paths``, staged in files for all cores: references are short, but each is looked up under many spellings."""
    spark = pairs.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Dealt by a hash of their own: by ``ref`` they lie already, in as few tasks as their bytes make.
    return stage(reference_paths(pairs).repartition(tasks, F.xxhash64("ref")), "references")


def resolve_pairs(pairs: DataFrame, known: DataFrame, refs: DataFrame) -> DataFrame:
    """Both sides of every pair with what is known about their references.

    ``refs`` holds the use counts; one image may be the input of most pairs.
    The resolved path comes back as ``<side>_found``, other columns under their names.
    """
    known = known.withColumnRenamed("path", "found")
    values = [c for c in known.columns if c != "ref"]
    for side in ("input", "output"):
        key = f"{side}_ref"
        hot = hot_keys(refs, ["ref"]).selectExpr(f"ref AS {key}")
        right = known.selectExpr(f"ref AS {key}", *[f"{c} AS {side}_{c}" for c in values])
        pairs = skew_left_join(pairs, right, [key], hot, ["file", "part", "row_index", "turn_pos"])
    return pairs


def file_manifest(listing: DataFrame) -> DataFrame:
    """Listed files under canonical relative paths, each once."""
    rest = [c for c in listing.columns if c != "path"]
    files = listing.selectExpr(f"{canonical_path('path')} AS path", *rest).filter("path <> ''")
    return files.dropDuplicates(["path"])
