"""DuckDB statements that compute the rows of the registered queries.

They follow the plain definition of each operator, candidate by candidate and
with global windows, so that they share no strategy with the Spark code.
"""

from __future__ import annotations

WS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


FILE = """concat(CASE lang WHEN 'en' THEN 'add_part' WHEN 'fr' THEN 'hybrid_part' WHEN 'de' THEN 'remove_part'
 ELSE 'reference_replace_part' END, source[4:], '.parquet')"""
FOLDER = """CASE doc_id % 5 WHEN 0 THEN 'results_compose_part2/' WHEN 1 THEN 'Singleturn/results_add/'
 WHEN 2 THEN './results_remove//' WHEN 3 THEN 'results_gone/' ELSE '' END"""

BASE = f"""base AS (SELECT {FILE} AS file, doc_id AS row_index, n_chars,
 concat({FOLDER}, 'd', doc_id, CASE WHEN doc_id % 5 = 4 THEN '' ELSE '/original' END, '.png') AS in_path,
 concat({FOLDER}, 'd', doc_id, CASE WHEN doc_id % 5 = 4 THEN '_e' ELSE '/edited' END, '.png') AS out_path,
 CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS prompt FROM documents)"""


def _flat(x: str) -> str:
    return f"list_filter(list_transform(flatten({x}), lambda p: {_strip('p')}), lambda p: p IS NOT NULL AND p <> '')"


LISTS = f"""{BASE}, lists AS (SELECT file, row_index, prompt,
 CASE WHEN file LIKE 'reference_replace%' THEN [[in_path], ['ref.png']]
  WHEN row_index % 11 = 0 THEN [[in_path], ['x.png']] WHEN row_index % 11 = 1 THEN NULL
  WHEN row_index % 11 = 2 THEN [[concat('  ', in_path, ' ')]] WHEN row_index % 11 = 3 THEN [[in_path, NULL]]
  ELSE [[in_path]] END AS input_images, [[out_path]] AS output_images FROM base),
 list_flat AS (SELECT *, {_flat('input_images')} AS ins, {_flat('output_images')} AS outs FROM lists),
 list_pairs AS (SELECT file, row_index, 0 AS turn_pos, ins[1] AS input_path, outs[1] AS output_path,
  {_strip("coalesce(prompt, '')")} AS prompt FROM list_flat
  WHERE len(input_images) = 1 AND len(output_images) = 1 AND len(ins) = 1 AND len(outs) = 1)"""

TURNS = f"""turn_pairs AS (SELECT 'content_memory_part2.parquet' AS file, conv_id AS row_index,
  CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS turn_pos,
  CASE WHEN turn % 4 <> 3 THEN concat('c', conv_id, '_', turn, '.png') END AS input_path,
  CASE WHEN role <> 'system' THEN concat('c', conv_id, '_', turn, '_e.png') END AS output_path,
  {_strip("coalesce(text, '')")} AS prompt FROM conversations),
 turn_kept AS (SELECT * FROM turn_pairs WHERE input_path IS NOT NULL AND output_path IS NOT NULL)"""

_SITE = "regexp_replace(url, '^https?://', '')"
COLUMNS = f"""column_pairs AS (SELECT 'pages_part0.parquet' AS file, page_id AS row_index, 0 AS turn_pos,
  {_SITE} AS input_path, concat({_SITE}, '_e') AS output_path, {_strip("html")} AS prompt FROM pages
  WHERE url NOT LIKE '%#top' AND url NOT LIKE 'http:%')"""

ALL = f"""{LISTS}, {TURNS}, {COLUMNS},
 all_pairs AS (SELECT * FROM list_pairs UNION ALL SELECT * FROM turn_kept UNION ALL SELECT * FROM column_pairs),
 all_rows AS (SELECT file, row_index FROM lists
  UNION ALL SELECT DISTINCT 'content_memory_part2.parquet', conv_id FROM conversations
  UNION ALL SELECT 'pages_part0.parquet', page_id FROM pages)"""

MANIFEST = """manifest AS (SELECT concat(CASE id % 5
   WHEN 0 THEN concat('Singleturn/results_hybrid_part2/d', id, '/', f)
   WHEN 1 THEN concat('Singleturn/results_add/d', id, '/', CASE WHEN id % 4 = 0 THEN upper(f) ELSE f END)
   WHEN 2 THEN concat('Singleturn/results_remove/d', id, '/', f)
   WHEN 3 THEN concat('Singleturn/results_moved/d', id, '/', f)
   ELSE concat('Singleturn/part1/d', id, CASE WHEN f = 'edited.png' THEN '_e' ELSE '' END, '.png') END,
   CASE WHEN id % 7 = 0 THEN '.part' ELSE '' END) AS path,
  CAST(CASE WHEN id % 17 = 0 THEN 0 ELSE 100 + id END AS BIGINT) AS size,
  id % 19 <> 0 OR f = 'edited.png' AS valid, CAST(n_chars AS INT) AS width, CAST(1 + id % 61 AS INT) AS height
 FROM (SELECT row_index AS id, n_chars, unnest(['original.png', 'edited.png']) AS f FROM base))"""

LISTING = f"""listing AS (SELECT path FROM manifest UNION ALL SELECT concat('pages/', {_SITE}) FROM pages)"""


def _norm(x: str) -> str:
    x = f"nfc_normalize(replace({_strip(x)}, '\\', '/'))"
    return f"ltrim(regexp_replace({x}, '/{{2,}}', '/', 'g'), './')"


def _canon(x: str) -> str:
    x = f"regexp_replace({x}, '/(\\.?/)+', '/', 'g')"
    return f"regexp_replace({x}, '^\\./|/\\.?$', '', 'g')"


def _subdir(x: str, folder: str) -> str:
    bare = _canon(_strip(x))
    return f"CASE WHEN contains({bare}, '/') THEN {x} ELSE concat('{folder}/', {bare}) END"


def _replace_first(x: str, old: str, new: str) -> str:
    return (
        f"CASE WHEN contains({x}, '{old}') THEN concat(left({x}, strpos({x}, '{old}') - 1), '{new}', "
        f"substr({x}, strpos({x}, '{old}') + {len(old)})) ELSE {x} END"
    )


def _ref(x: str) -> str:
    s = f"({_strip(_subdir(x, 'Singleturn/part1'))})"
    s = f"(CASE WHEN file LIKE 'hybrid\\_part%' ESCAPE '\\' THEN {_replace_first(s, 'results_compose', 'results_hybrid')} ELSE {s} END)"
    return f"CASE WHEN lower({s}) NOT IN ('', 'none', 'null') THEN {s} END"


_TURN = "'^(singleturn|multiturn)/+', '', 'i'"

REFS = f"""{LISTS}, {MANIFEST}, pair_refs AS (SELECT *, {_ref('input_path')} AS input_ref, {_ref('output_path')} AS output_ref
  FROM list_pairs), refs AS (SELECT input_ref AS ref FROM pair_refs UNION SELECT output_ref FROM pair_refs)"""

SPELL = f"""normed AS (SELECT ref, {_norm('ref')} AS n FROM refs),
 stripped AS (SELECT ref, n, regexp_replace(n, {_TURN}) AS s1 FROM normed),
 stripped2 AS (SELECT *, regexp_replace(s1, {_TURN}) AS s2 FROM stripped),
 stripped3 AS (SELECT *, regexp_replace(s2, {_TURN}) AS s3 FROM stripped2),
 stripped4 AS (SELECT *, regexp_replace(s3, {_TURN}) AS s4 FROM stripped3),
 spelled AS (SELECT ref, unnest([n, {_strip('ref')}, s1, s2, s3, s4]) AS v, unnest([0, 1, 2, 3, 4, 5]) AS j FROM stripped4),
 variants AS (SELECT ref, v, row_number() OVER (PARTITION BY ref ORDER BY min(j)) - 1 AS j
  FROM spelled WHERE v <> '' GROUP BY ref, v)"""

RESOLVE = f"""{REFS}, {SPELL},
 places(p, folder, bare) AS (VALUES (0, '', false), (1, 'Singleturn/', false), (2, 'Multiturn/', false),
  (3, 'Parquet/', false), (4, '', true), (5, 'Singleturn/', true), (6, 'Multiturn/', true)),
 candidates AS (SELECT ref, 7 * j + p AS rank,
   concat(folder, {_canon("CASE WHEN bare THEN ltrim(v, './') ELSE v END")}) AS path FROM variants, places),
 files AS (SELECT path, regexp_extract(path, '^(.*/)?', 0) AS dir, lower(regexp_extract(path, '[^/]*$', 0)) AS fold
  FROM manifest),
 tried AS (
  SELECT ref, 2 * rank AS rank, f.path FROM candidates c JOIN files f ON f.path = c.path
  UNION ALL SELECT ref, 2 * rank + 1, f.path FROM candidates c JOIN files f
   ON f.dir = regexp_extract(c.path, '^(.*/)?', 0) AND f.fold = lower(regexp_extract(c.path, '[^/]*$', 0))),
 direct AS (SELECT ref, arg_min(path, (rank, path)) AS path FROM tried GROUP BY ref),
 tails AS (SELECT ref, j, split_part({_canon('v')}, '/', -2) AS parent, lower(split_part({_canon('v')}, '/', -1)) AS fold
  FROM variants WHERE contains({_canon('v')}, '/')),
 tasks AS (SELECT path, split_part(path, '/', 2) AS task, split_part(path, '/', 3) AS parent, lower(split_part(path, '/', 4)) AS fold
  FROM manifest WHERE regexp_full_match(path, 'Singleturn/results_[^/]*/[^/]+/[^/]+')),
 siblings AS (SELECT ref, j, min(path) AS path FROM tails JOIN tasks USING (parent, fold)
  GROUP BY ref, j HAVING count(DISTINCT task) = 1),
 found AS (SELECT ref, path, true AS direct FROM direct
  UNION ALL SELECT ref, arg_min(path, j), false FROM siblings WHERE ref NOT IN (SELECT ref FROM direct) GROUP BY ref),
 audited AS (SELECT p.*, i.path AS input_found, o.path AS output_found FROM pair_refs p
  LEFT JOIN found i ON i.ref = p.input_ref LEFT JOIN found o ON o.ref = p.output_ref)"""

AUDIT = f"""{RESOLVE}, audit AS (SELECT file, count(*) AS rows, any_value(strict_pairs) AS strict_pairs,
   any_value(both_exist) AS both_exist FROM lists LEFT JOIN (SELECT file, count(*) AS strict_pairs,
    count(*) FILTER (input_found IS NOT NULL AND output_found IS NOT NULL) AS both_exist FROM audited GROUP BY file) USING (file)
   GROUP BY file),
 audit_files AS (SELECT file, rows, coalesce(strict_pairs, 0) AS strict_pairs, coalesce(both_exist, 0) AS both_exist,
   coalesce(strict_pairs, 0) - coalesce(both_exist, 0) AS broken_pairs, both_exist / strict_pairs AS resolve_rate FROM audit)"""

BUILT = f"""{AUDIT}, built AS (SELECT a.file, a.row_index, a.turn_pos, a.prompt,
   CASE WHEN coalesce(i.size, 0) = 0 OR coalesce(o.size, 0) = 0 THEN 'missing_file'
    WHEN NOT (i.valid AND o.valid) THEN 'bad_image' ELSE 'kept' END AS status
  FROM audited a LEFT JOIN manifest i ON i.path = a.input_found LEFT JOIN manifest o ON o.path = a.output_found),
 kept AS (SELECT *, row_number() OVER (ORDER BY file, row_index, turn_pos) - 1 AS pair_index FROM built WHERE status = 'kept'),
 samples AS (SELECT *, pair_index // 100 AS shard_id, printf('shard-%05d.tar', pair_index // 100) AS shard_name,
  concat(replace(file, '.parquet', ''), '_', printf('%08d', pair_index), '_',
   sha256(concat(replace(file, '.parquet', ''), chr(0), pair_index, chr(0), prompt))[1:20]) AS key FROM kept)"""

_COUNTS = """count(b.file) AS pairs_emitted, count(*) FILTER (status = 'kept') AS kept,
 count(*) FILTER (status = 'missing_file') AS missing_file, count(*) FILTER (status = 'bad_image') AS bad_image,
 count(*) FILTER (status = 'unchecked') AS unchecked"""

VERDICTS = f"""{BUILT}, build AS (SELECT file, count(*) FILTER (status = 'kept') AS kept FROM built GROUP BY file),
 verdicts AS (SELECT a.file, a.strict_pairs, CASE WHEN a.file LIKE '%7.parquet' THEN 'unknown_layout' WHEN strict_pairs = 0 THEN 'no_strict_pairs'
   WHEN coalesce(resolve_rate, -1) < 0.8 THEN 'low_resolve_rate' WHEN coalesce(kept, 0) = 0 THEN 'nothing_kept' END AS reason
  FROM audit_files a LEFT JOIN build USING (file))"""

ON_DISK = f"{BASE}, {MANIFEST}"

PATHS = f"""{BASE}, p AS (SELECT row_index, prompt, CASE row_index % 6 WHEN 0 THEN concat('  /.//', in_path, chr(9))
  WHEN 1 THEN replace(in_path, '/', '\\') WHEN 2 THEN concat('MultiTurn//singleturn/', in_path)
  WHEN 3 THEN concat('cafe', chr(769), '/', in_path) WHEN 4 THEN concat('./', in_path) ELSE in_path END AS path FROM base)"""

_TAR = "regexp_extract(path, '^(.*/)?([^/]+\\.tar)\\.split\\.(\\d+)$', {})"

_LONG, _SHORT = "greatest(width, height)", "least(width, height)"
_IDEAL = f"(2048 * {_SHORT} / {_LONG})"


def _off(n: str) -> str:
    return (
        f"CASE WHEN width >= height THEN CASE WHEN {n} = 0 THEN 0 ELSE abs(width / height - 2048 / nullif({n}, 0)) END "
        f"ELSE abs(width / height - {n} / 2048) END"
    )


_NEAR = (
    f"greatest(1, CASE WHEN {_off(f'floor({_IDEAL})')} <= {_off(f'ceil({_IDEAL})')} "
    f"THEN floor({_IDEAL}) ELSE ceil({_IDEAL}) END)"
)


def _glob(tier: int, pattern: str, test: str) -> str:
    return f"SELECT '{pattern}' AS pattern, {tier} AS tier, path FROM n WHERE {test}"


def statements() -> dict[str, str]:
    members = """SELECT shard_name, unnest([concat(key, CASE WHEN row_index % 29 = 0 THEN '.jpeg' ELSE '.jpg' END),
       concat(key, '.jpg2'), concat(key, '.txt'), concat(key, CASE WHEN row_index % 31 = 0 THEN '.x.txt' ELSE '.json' END),
       replace(key, '_', '')]) AS member FROM samples"""
    rules = _replace_first("path", "results_", "task_")
    rules = _replace_first(f"({rules})", "e", "E")
    return {
        "scan_pairs": f"""WITH {LISTS} SELECT l.file, CAST(count(p.file) AS INT) AS n_pairs, any_value(p.input_path) AS input_path,
            any_value(p.prompt) AS prompt FROM lists l LEFT JOIN list_pairs p USING (file, row_index) GROUP BY l.file, l.row_index""",
        "filter_files": f"""WITH {LISTS} SELECT file, count(*) AS rows, count(p.file) AS pairs FROM lists l
            LEFT JOIN list_pairs p USING (file, row_index) WHERE l.file IN ('add_part1.parquet', 'hybrid_part2.parquet') GROUP BY l.file""",
        "profile_files": f"""WITH {BASE} SELECT file, count(*) AS rows, CAST(4 AS INT) AS columns,
            'row_index,input_images,output_images,prompt' AS names,
            'int64,list<element: list<element: string> not null>,list<element: list<element: string> not null>,string' AS types,
            'lists' AS layout, 'input_images' AS input_col, 'output_images' AS output_col, 'prompt' AS text_col FROM base GROUP BY file""",
        "classify_schema": """SELECT concat('f', doc_id, '.parquet') AS file, x.* FROM documents JOIN (VALUES
            (0, 'multiturn', NULL, NULL, 'prompt'), (1, 'lists', 'input_images', 'output_images', 'prompt'),
            (2, 'path', 'Input_Images', 'Output_Images', 'TEXT'), (3, 'embed', 'source_img', 'edited_img', 'instruction'),
            (4, 'path', 'source_path', 'edited', NULL), (5, 'mixed_embed_orig', 'original_img', 'target_path', NULL),
            (6, 'mixed_embed_edit', 'input_path', 'output_img', 'text'), (7, 'unknown', NULL, NULL, NULL),
            (8, 'path', 'original_path', 'edited_path', NULL)) x(k, layout, input_col, output_col, text_col) ON k = doc_id % 9""".replace("x.*", "layout, input_col, output_col, text_col"),
        "file_manifest": f"WITH {ON_DISK} SELECT path, size > 0 AS has_bytes FROM manifest",
        "slice_files": f"""WITH {ON_DISK} SELECT path, size > 0 AS has_bytes FROM manifest
            WHERE starts_with(path, 'Singleturn/results_add/') OR starts_with(path, 'Singleturn/part1/')""",
        "match_globs": f"""WITH {ON_DISK}, {LISTING}, n AS (SELECT path, {_norm('path')} AS n FROM listing), hits AS (
            {_glob(1, 'Singleturn/results_add/*/original.png', "n GLOB 'Singleturn/results_add/*/original.png'")}
            UNION {_glob(2, './singleturn/RESULTS_hybrid*/d?/*.PNG', "lower(n) GLOB 'singleturn/results_hybrid*/d?/*.png'")}
            UNION {_glob(1, 'Singleturn/part1/d[!1-8]*', "n GLOB 'Singleturn/part1/d[!1-8]*'")}
            UNION {_glob(1, 'pages/*/de/[0-4]*', "n GLOB 'pages/*/de/[0-4]*'")}) SELECT * FROM hits""",
        "check_split_parts": f"""WITH parts AS (SELECT concat('Singleturn/results_s', l_suppkey, '/a', l_orderkey, '.tar.split.',
              CASE WHEN l_linestatus = 'O' THEN '00' ELSE '' END, l_linenumber, CASE WHEN l_returnflag = 'R' THEN '.part' ELSE '' END) AS path,
              CAST(l_quantity AS BIGINT) AS size FROM lineitem),
            p AS (SELECT {_TAR.format(1)} AS dir, {_TAR.format(2)} AS base, CAST({_TAR.format(3)} AS BIGINT) AS idx, size FROM parts
              WHERE regexp_full_match(path, '(.*/)?[^/]+\\.tar\\.split\\.\\d+'))
            SELECT dir, base, min(idx) AS first, max(idx) AS last, count(*) AS parts, count(DISTINCT idx) AS indices,
              CAST(sum(size) AS BIGINT) AS bytes, max(idx) - min(idx) + 1 = count(*) AND count(*) = count(DISTINCT idx) AS complete FROM p GROUP BY dir, base""",
        "scan_tar_members": f"""WITH {BUILT} SELECT concat('Singleturn/', shard_name) AS archive, concat(key, '.', s) AS member,
            CASE WHEN s = 'txt' THEN concat(prompt, chr(10)) END AS text, true AS whole FROM samples, (VALUES ('jpg'), ('jpg2'), ('txt')) v(s)""",
        "scan_image_bytes": f"""WITH {ON_DISK} SELECT path, CASE WHEN size > 0 THEN width END AS width,
            CASE WHEN size > 0 THEN height END AS height, size = 0 AS is_missing FROM manifest""",
        "flatten_paths": f"WITH {LISTS} SELECT file, row_index, CAST(coalesce(len(ins), 0) AS INT) AS n, coalesce(array_to_string(ins, '|'), '') AS flat FROM list_flat",
        "pairs_from_lists": f"WITH {LISTS} SELECT * FROM list_pairs",
        "pairs_from_turns": f"WITH {TURNS} SELECT * FROM turn_kept",
        "pairs_from_columns": f"WITH {COLUMNS} SELECT * FROM column_pairs",
        "clean_prompt": f"WITH {BASE} SELECT row_index, {_strip(chr(39) * 2)} || coalesce({_strip('prompt')}, '') AS prompt FROM base",
        "emit_pairs": f"WITH {ALL} SELECT * FROM all_pairs",
        "normalize_path": f"WITH {PATHS} SELECT row_index, {_norm('path')} AS path FROM p",
        "path_variants": f"""WITH {PATHS}, refs AS (SELECT DISTINCT path AS ref FROM p), {SPELL}
            SELECT row_index, CAST(j AS INT) AS nth, v AS variant FROM p JOIN variants ON ref = path""",
        "substitute_paths": f"WITH {PATHS} SELECT row_index, {rules} AS path FROM p",
        "slice_rules": f"""WITH {BASE}, r AS (SELECT file, row_index, CASE WHEN file LIKE 'hybrid%' OR file = 'add_part3.parquet'
            THEN [('results_compose', 'results_hybrid'), ('a', 'b')] ELSE [('a', 'b')] END AS rs FROM base),
            x AS (SELECT file, row_index, unnest(rs) AS r FROM r) SELECT file, row_index, r[1] AS old, r[2] AS new FROM x""",
        "prepend_subdir": f"WITH {PATHS} SELECT row_index, {_subdir('path', 'Singleturn/part1')} AS path FROM p",
        "root_prefix": f"WITH {PATHS} SELECT row_index, split_part(trim(path, '/'), '/', 1) AS root FROM p",
        "is_basename_only": f"""WITH {PATHS} SELECT row_index, NOT contains(trim(path, '/'), '/')
            AND regexp_matches(lower(trim(path, '/')), '\\.(jpg|jpeg|png|webp|bmp|gif)$') AS bare FROM p""",
        "null_path": f"WITH {PATHS} SELECT row_index, CASE WHEN row_index % 4 = 2 THEN {_strip('path')} END AS path FROM p",
        "fold_text": "SELECT doc_id, nfc_normalize(text) AS nfc, replace(lower(text), 'ß', 'ss') AS folded FROM documents",
        "sample_key": f"""WITH {BASE}, b AS (SELECT row_index, replace(file, '.parquet', '') AS stem, coalesce(prompt, '') AS prompt FROM base)
            SELECT row_index, concat(stem, '_', printf('%08d', row_index), '_', sha256(concat(stem, chr(0), row_index, chr(0), prompt))[1:20]) AS key FROM b""",
        "shard_name": f"""WITH {BASE} SELECT row_index, concat(CASE WHEN row_index % 2 = 0 THEN concat(replace(file, '.parquet', ''), '-') ELSE '' END,
            'shard-', printf('%05d', row_index * 37), '.tar') AS name FROM base""",
        "slice_layout": f"WITH {BASE} SELECT concat('out/', replace(file, '.parquet', ''), '/') AS folder, count(*) AS rows FROM base GROUP BY file",
        "resolve_exact": f"""WITH {RESOLVE} SELECT ref, path FROM found WHERE direct
            AND split_part(ref, '/', -1) = split_part(path, '/', -1)""",
        "resolve_casefold": f"""WITH {RESOLVE} SELECT ref, path FROM found WHERE direct
            AND split_part(ref, '/', -1) <> split_part(path, '/', -1)""",
        "resolve_sibling": f"WITH {RESOLVE} SELECT ref, path FROM found WHERE NOT direct",
        **dict.fromkeys(("resolve_paths", "resolve_paths_saved"), f"WITH {RESOLVE} SELECT ref, path, size FROM refs LEFT JOIN found USING (ref) LEFT JOIN manifest USING (path)"),
        "resolve_pairs": f"WITH {RESOLVE} SELECT file, row_index, turn_pos, input_found, output_found FROM audited",
        "missing_roots": f"""WITH {ALL}, {MANIFEST}, {LISTING}, roots AS (SELECT file, split_part(trim(unnest([input_path, output_path]), '/'), '/', 1) AS root FROM all_pairs),
            joined AS (SELECT string_agg(path, chr(10)) AS text FROM listing)
            SELECT file, root, count(*) AS paths FROM roots, joined WHERE root <> ''
             AND NOT regexp_matches(lower(root), '\\.(jpg|jpeg|png|webp|bmp|gif)$') AND NOT contains(text, root) GROUP BY file, root""",
        "explore_stats": f"""WITH {ALL}, per_row AS (SELECT r.file, r.row_index, count(p.file) AS n,
              coalesce(bool_or(NOT contains(trim(input_path, '/'), '/') AND lower(trim(input_path, '/')) LIKE '%.png'
               OR NOT contains(trim(output_path, '/'), '/') AND lower(trim(output_path, '/')) LIKE '%.png'), false) AS bare
              FROM all_rows r LEFT JOIN all_pairs p USING (file, row_index) GROUP BY r.file, r.row_index)
            SELECT file, count(*) AS rows_total, CAST(sum(n) AS BIGINT) AS strict_pairs, count(*) FILTER (n = 0) AS rows_without_pairs,
              count(*) FILTER (n > 1) AS rows_with_many_pairs, bool_or(bare) AS has_basename_only FROM per_row GROUP BY file""",
        "root_histogram": f"""WITH {ALL}, roots AS (SELECT file, split_part(trim(unnest([input_path, output_path]), '/'), '/', 1) AS root FROM all_pairs)
            SELECT file, root, count(*) AS paths FROM roots WHERE root <> '' GROUP BY file, root""",
        "explore_totals": f"""WITH {ALL} SELECT (SELECT count(*) FROM all_rows) AS rows_total, (SELECT count(*) FROM all_pairs) AS strict_pairs,
            (SELECT count(DISTINCT file) FROM all_rows) + (SELECT count(DISTINCT s_suppkey) FROM supplier) AS files""",
        "audit_stats": f"WITH {AUDIT} SELECT * FROM audit_files",
        "write_reports": f"WITH {AUDIT} SELECT * FROM audit_files",
        "audit_examples": f"""WITH {RESOLVE}, broken AS (SELECT *, CAST(row_number() OVER (PARTITION BY file ORDER BY row_index, turn_pos) AS INT) AS nth
              FROM audited WHERE input_found IS NULL OR output_found IS NULL)
            SELECT file, nth, {_subdir('input_path', 'Singleturn/part1')} AS input, {_subdir('output_path', 'Singleturn/part1')} AS output,
              CASE WHEN input_found IS NULL AND output_found IS NULL THEN 'missing_both' WHEN input_found IS NULL THEN 'missing_input'
               ELSE 'missing_output' END AS reason FROM broken WHERE nth <= 8""",
        "build_stats": f"""WITH {BUILT} SELECT l.file, count(*) AS rows, {_COUNTS} FROM lists l
            LEFT JOIN built b ON b.file = l.file AND b.row_index = l.row_index GROUP BY l.file""",
        "slice_gate": f"WITH {VERDICTS} SELECT file, CASE WHEN reason IS NULL THEN 'SUCCESS' ELSE 'SKIPPED' END AS verdict, reason FROM verdicts",
        "run_summary": f"""WITH {VERDICTS}, parts AS (SELECT l_suppkey, l_orderkey, l_linenumber AS idx
              FROM lineitem WHERE l_returnflag <> 'R'),
            torn AS (SELECT l_suppkey, l_orderkey FROM parts GROUP BY ALL HAVING max(idx) - min(idx) + 1 <> count(*) OR count(*) <> count(DISTINCT idx)),
            failures AS (SELECT DISTINCT file FROM (SELECT DISTINCT file, regexp_extract(file, '([0-9]+)[.]parquet$', 1) AS n FROM lists) f
              JOIN torn ON CAST(l_suppkey AS VARCHAR) = n AND starts_with(CAST(l_orderkey AS VARCHAR), n) WHERE n <> '')
            SELECT count(*) FILTER (reason IS NULL AND NOT f) AS success, count(*) FILTER (reason IS NOT NULL AND NOT f) AS skipped,
              count(*) FILTER (f) AS failed FROM (SELECT reason, file IN (SELECT file FROM failures) AS f FROM verdicts)""",
        "pair_index": f"WITH {BUILT} SELECT file, row_index, turn_pos, pair_index FROM kept",
        "pair_index_per_file": f"""WITH {BUILT} SELECT file, row_index, turn_pos,
            row_number() OVER (PARTITION BY file ORDER BY row_index, turn_pos) - 1 AS pair_index FROM kept""",
        "assign_shards": f"WITH {BUILT} SELECT key, pair_index, shard_id, shard_name FROM samples",
        **dict.fromkeys(("limit_shards", "build_first_shards"), f"""WITH {BUILT}, stop AS (SELECT file AS sf, row_index AS sr, turn_pos AS st FROM kept WHERE pair_index = 299),
            r AS (SELECT l.file, l.row_index FROM lists l, stop WHERE l.file < sf OR (l.file = sf AND l.row_index // 256 <= sr // 256)
              UNION ALL SELECT l.file, l.row_index FROM lists l WHERE NOT EXISTS (FROM stop)),
            b AS (SELECT built.* FROM built, stop WHERE (file, row_index, turn_pos) <= (sf, sr, st)
              UNION ALL SELECT * FROM built WHERE NOT EXISTS (FROM stop))
            SELECT r.file, count(*) AS rows, {_COUNTS} FROM r LEFT JOIN b ON b.file = r.file AND b.row_index = r.row_index GROUP BY r.file"""),
        "skip_existing": f"""WITH {BUILT} SELECT key, shard_name FROM samples WHERE shard_name NOT IN
            (SELECT printf('shard-%05d.tar', o_orderkey * 2 + 1) FROM orders)""",
        "verify_shards": f"""WITH {BUILT}, m AS ({members}), s AS (SELECT shard_name, regexp_extract(member, '^(.*)\\.([^.]*)$', 1) AS key,
              regexp_extract(member, '^(.*)\\.([^.]*)$', 2) AS suffix FROM m WHERE contains(member, '.')),
            k AS (SELECT shard_name, key, count(DISTINCT suffix) < 3 AS bad, count(*) FILTER (suffix = 'jpg') AS j,
              count(*) FILTER (suffix = 'jpg2') AS j2, count(*) FILTER (suffix = 'txt') AS t FROM s
              WHERE suffix IN ('jpg', 'jpg2', 'txt') GROUP BY shard_name, key),
            x AS (SELECT shard_name, CAST(sum(j) AS BIGINT) AS n_jpg, CAST(sum(j2) AS BIGINT) AS n_jpg2, CAST(sum(t) AS BIGINT) AS n_txt,
              count(*) FILTER (bad) AS bad_keys, coalesce(array_to_string((list(key ORDER BY key) FILTER (bad))[1:3], ','), '') AS examples
              FROM k GROUP BY shard_name),
            e AS (SELECT shard_name, count(*) AS samples FROM samples GROUP BY shard_name)
            SELECT *, CASE WHEN bad_keys > 0 THEN 'incomplete_keys' WHEN NOT (n_jpg = samples AND n_jpg2 = samples AND n_txt = samples)
              THEN 'wrong_count' END AS problem, bad_keys = 0 AND n_jpg = samples AND n_jpg2 = samples AND n_txt = samples AS ok FROM e JOIN x USING (shard_name)""",
        "image_validity": f"""WITH {ON_DISK}, v AS (SELECT path, size > 0 AND valid AS ok, width, height FROM manifest)
            SELECT path, ok AS valid, CASE WHEN ok THEN width END AS width, CASE WHEN ok THEN height END AS height FROM v""",
        "image_validity_jvm": f"""WITH {ON_DISK} SELECT path, valid, CASE WHEN valid THEN width END AS width,
            CASE WHEN valid THEN height END AS height FROM manifest WHERE size > 0""",
        "image_fit": f"""WITH {ON_DISK} SELECT path, CAST(CASE WHEN {_LONG} <= 2048 THEN width WHEN width >= height THEN 2048 ELSE {_NEAR} END AS INT) AS width,
            CAST(CASE WHEN {_LONG} <= 2048 THEN height WHEN width >= height THEN {_NEAR} ELSE 2048 END AS INT) AS height
            FROM manifest WHERE size > 0 AND valid""",
        "image_validity_archived": """WITH d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
            s AS (SELECT doc_id, greatest(1, CAST(ceil(sqrt(n)) AS BIGINT)) AS w, n, doc_id % 7 <> 0 AND doc_id % 11 <> 0 AS ok FROM d)
            SELECT doc_id, ok AS valid, CASE WHEN ok THEN CAST(8 * w AS INT) END AS width,
             CASE WHEN ok THEN CAST(8 * greatest(1, ceil(n / w)) AS INT) END AS height, 'jpeg' AS checked_by FROM s""",
        "write_shards": f"""WITH {BUILT} SELECT shard_name, CAST(row_number() OVER (PARTITION BY shard_name ORDER BY pair_index, i) AS INT) AS nth,
            concat(key, '.', s) AS member FROM samples, (VALUES (0, 'jpg'), (1, 'jpg2'), (2, 'txt')) v(i, s)""",
        "verify_decode": f"""WITH {BUILT} SELECT shard_name, 3 * least(count(*), 3) AS members_read, CAST(0 AS BIGINT) AS unreadable, CAST(0 AS BIGINT) AS unchecked
            FROM samples GROUP BY shard_name""",
        "slice_archives": f"""WITH {ON_DISK} SELECT 'add_part0' AS stem, path FROM manifest WHERE path GLOB 'Singleturn/results_add/*/original.png'
            UNION ALL SELECT 'hybrid_part2', path FROM manifest WHERE lower(path) GLOB 'singleturn/results_hybrid*/d?/*.png'""",
        "split_arrivals": """SELECT concat('Singleturn/results_c', o_custkey % 7, '/c', o_custkey, '.tar') AS archive, count(*) AS parts,
            CAST(sum(1 + o_orderkey % 1000) AS BIGINT) AS bytes FROM orders GROUP BY o_custkey HAVING NOT bool_or(o_orderkey % 97 = 5)""",
        "ingest_slices": f"""WITH {BUILT}, v AS (SELECT file, strict_pairs, CASE WHEN strict_pairs = 0 THEN 'no_strict_pairs'
              WHEN resolve_rate < 0.8 THEN 'low_resolve_rate' END AS reason FROM audit_files),
            s AS (SELECT file, count(*) AS samples FROM kept GROUP BY file),
            g AS (SELECT file, strict_pairs, samples, coalesce(reason, CASE WHEN samples IS NULL THEN 'nothing_kept' END) AS reason FROM v LEFT JOIN s USING (file))
            SELECT file, strict_pairs, CASE WHEN reason IS NULL THEN 'SUCCESS' ELSE 'SKIPPED' END AS verdict, reason,
              CASE WHEN reason IS NULL THEN samples END AS samples, CASE WHEN reason IS NULL THEN samples - 1 END AS last_index
            FROM g""",
    }
