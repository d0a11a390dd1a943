"""Strict one-input/one-output pairs from the accepted row layouts.

A row keeps its pairs as one array column. Row-level counts read the size of
that array, so nothing is exploded or joined before pairs are needed.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.text import strip

# Columns of the list and multi-turn layouts.
INPUT, OUTPUT, PROMPT, TURNS = "input_images", "output_images", "prompt", "data"

PAIR = "struct<turn_pos:int,input_path:string,output_path:string>"
KEYS = ["file", "part", "row_index"]

# Layouts with embedded images are recognised but give no pairs.
NO_PAIRS = f"CAST(array() AS array<{PAIR}>)"
NO_PATHS = "CAST(array() AS array<string>)"


def _kept(paths: str) -> str:
    return f"filter({paths}, p -> p <> '')"


def flatten_paths(x: str, dtype: T.DataType, depth: int = 0) -> str:
    """All non-blank strings of a nested list, stripped, in order."""
    if isinstance(dtype, T.StringType):
        return _kept(f"array({strip(x)})")
    if not isinstance(dtype, T.ArrayType):
        return NO_PATHS
    item = f"e{depth}"
    x = f"coalesce({x}, CAST(array() AS {dtype.simpleString()}))"
    if isinstance(dtype.elementType, T.StringType):
        return _kept(f"transform({x}, {item} -> {strip(item)})")
    return f"flatten(transform({x}, {item} -> {flatten_paths(item, dtype.elementType, depth + 1)}))"


def clean_prompt(x: str) -> str:
    """Stripped prompt; a missing one becomes empty, and empty ones are kept."""
    return strip(f"coalesce(CAST({x} AS STRING), '')")


def _strict(found: str) -> str:
    """Keep the candidates with exactly one path on each side."""
    return f"""transform(filter({found}, x -> size(x.ins) = 1 AND size(x.outs) = 1),
        x -> struct(x.pos AS turn_pos, x.ins[0] AS input_path, x.outs[0] AS output_path))"""


def _one(ins: str, outs: str) -> str:
    return _strict(f"array(struct(0 AS pos, {ins} AS ins, {outs} AS outs))")


def pairs_from_lists(schema: T.StructType, input_col: str = INPUT, output_col: str = OUTPUT) -> str:
    """List layout: one top-level slot per side that holds exactly one path."""

    def side(name: str) -> str:
        dtype = schema[name].dataType
        paths = flatten_paths(f"`{name}`", dtype)
        if isinstance(dtype, T.ArrayType):
            paths = f"IF(size(`{name}`) = 1, {paths}, {NO_PATHS})"
        return paths

    return _one(side(input_col), side(output_col))


def _turn_type(schema: T.StructType) -> T.StructType | None:
    dtype = schema[TURNS].dataType
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        return dtype.elementType
    return None


def pairs_from_turns(schema: T.StructType) -> str:
    """Multi-turn layout: every turn with one path on each side is a pair."""
    turn = _turn_type(schema)
    if turn is None:
        return NO_PAIRS

    def side(name: str) -> str:
        return flatten_paths(f"t.{name}", turn[name].dataType) if name in turn.names else NO_PATHS

    turns = f"coalesce({TURNS}, CAST(array() AS {schema[TURNS].dataType.simpleString()}))"
    return _strict(f"transform({turns}, (t, i) -> struct(i AS pos, {side(INPUT)} AS ins, {side(OUTPUT)} AS outs))")


def pairs_from_columns(schema: T.StructType, input_col: str, output_col: str) -> str:
    """Plain layout: a scalar path, or a list that holds exactly one."""

    def side(name: str) -> str:
        dtype = schema[name].dataType
        if isinstance(dtype, T.ArrayType):
            return flatten_paths(f"`{name}`", dtype)
        return flatten_paths(f"CAST(`{name}` AS STRING)", T.StringType())

    return _one(side(input_col), side(output_col))


def row_prompts(schema: T.StructType, layout: str, text_col: str | None) -> str:
    """Prompts of a row by turn; rows of the other layouts have one turn."""
    if layout == "multiturn":
        turn = _turn_type(schema)
        prompt = f"t.{PROMPT}" if turn is not None and PROMPT in turn.names else "NULL"
        return f"transform({TURNS}, t -> {clean_prompt(prompt)})"
    text_col = text_col or PROMPT
    return f"array({clean_prompt(f'`{text_col}`' if text_col in schema.names else 'NULL')})"


def read_rows(
    df: DataFrame,
    layout: str,
    input_col: str | None = INPUT,
    output_col: str | None = OUTPUT,
    text_col: str | None = PROMPT,
    keys: list | None = None,
) -> DataFrame:
    """Rows in the common form: file, part and row, their pairs and their prompts.

    Prompts are a column of their own, so that steps which need only paths
    never read them.
    """
    if layout == "multiturn":
        pairs = pairs_from_turns(df.schema)
    elif layout == "lists":
        pairs = pairs_from_lists(df.schema, input_col, output_col)
    elif layout == "path":
        pairs = pairs_from_columns(df.schema, input_col, output_col)
    else:
        pairs = NO_PAIRS
    prompts = NO_PATHS if pairs == NO_PAIRS else row_prompts(df.schema, layout, text_col)
    return df.select(*(keys or KEYS), F.expr(pairs).alias("pairs"), F.expr(prompts).alias("prompts"))


def emit_pairs(rows: DataFrame, prompts: bool = True) -> DataFrame:
    """One row per strict pair."""
    if not prompts:
        return rows.selectExpr(*KEYS, "inline(pairs)")
    with_prompt = "struct(p.turn_pos, p.input_path, p.output_path, prompts[p.turn_pos] AS prompt)"
    return rows.selectExpr(*KEYS, f"inline(transform(pairs, p -> {with_prompt}))")
