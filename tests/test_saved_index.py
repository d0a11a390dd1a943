"""The index kept between runs: the same answers, and no shuffle of what it holds."""

import random

import pytest

from pairloom.operators import saved_index
from pairloom.operators.resolve import file_manifest, resolve_paths
from pairloom.sources.listing import whole_file

FOLDERS = ["Singleturn/results_add/x", "Singleturn/results_rem/x", "Multiturn/a", "Parquet", "", "Singleturn/part1"]


@pytest.fixture(scope="module")
def manifest(spark):
    rng = random.Random(3)
    names = {f"{rng.choice(FOLDERS)}/{rng.choice('abcdÉ')}{rng.randrange(30)}.{rng.choice(['png', 'PNG'])}".lstrip("/") for _ in range(400)}
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(sorted(names))], "path string, size long")
    return file_manifest(rows).selectExpr("*", f"{whole_file('path')} AS segments")


@pytest.fixture(scope="module")
def refs(spark):
    rng = random.Random(4)
    tails = [f"{rng.choice('abcdéÉ')}{rng.randrange(30)}.{rng.choice(['png', 'PNG'])}" for _ in range(200)]
    return spark.createDataFrame([(f"{rng.choice(['', './', 'x/', 'results_gone/x/', 'Singleturn/results_add/x/', 'a/'])}{t}",) for t in tails], "ref string").distinct()


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def index(manifest, tmp_path_factory):
    return saved_index.save_index(manifest, str(tmp_path_factory.mktemp("saved") / "index"), buckets=4)


@pytest.mark.parametrize("sibling", [True, False])
@pytest.mark.parametrize("locate", [True, False])
def test_saved_index_gives_the_same(manifest, refs, index, locate, sibling):
    want = resolve_paths(refs, manifest, sibling=sibling, locate=locate)
    got = resolve_paths(refs, index, sibling=sibling, locate=locate)
    assert got.columns == want.columns and rows(got) == rows(want) and want.count() > 30


def test_another_session_opens_it(spark, manifest, refs, tmp_path):
    folder = str(tmp_path / "it's here")
    saved_index.save_index(manifest, folder)
    for name in ("entries", "files"):
        spark.sql(f"DROP TABLE {saved_index._table(folder, name)}")  # as in a new catalog; the files stay
    again = saved_index.open_index(spark, folder)
    assert rows(resolve_paths(refs, again)) == rows(resolve_paths(refs, manifest))
    with pytest.raises(ValueError, match="saved for"):
        resolve_paths(refs, again, "Elsewhere")


def shuffles_above(plan, table):
    """Names of the nodes between each scan of a table and the join it feeds."""
    lines, found = plan.splitlines(), []
    depth = lambda line: len(line) - len(line.lstrip(" :+-*("))
    for i, line in enumerate(lines):
        if "FileScan parquet" in line and table in line:
            at, path = depth(line), []
            for above in reversed(lines[:i]):
                if depth(above) < at:
                    at = depth(above)
                    path.append(above)
                    if "Join" in above:
                        break
            found.append("\n".join(path))
    return found


@pytest.mark.parametrize("locate", [True, False])
def test_no_shuffle_of_the_index(spark, refs, index, locate):
    """What audits (without locating) and builds and publications (with it) run."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.maxMetadataStringLength": "10000"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = resolve_paths(refs, index, locate=locate)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    scans = shuffles_above(plan, "pairloom_entries") + (shuffles_above(plan, "pairloom_files") if locate else [])
    assert len(scans) >= 1 + locate
    shuffled = [s for s in scans if "Exchange" in s.replace("BroadcastExchange", "")]
    assert not shuffled, plan
