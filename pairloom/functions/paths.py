"""Path algebra."""

from collections.abc import Sequence

from pairloom.functions import text_literal
from pairloom.functions.text import let, nfc, strip

# Fixed values.
TURN_PREFIX = "r'(?i)^(?:singleturn|multiturn)/+'"
MAX_TURN_PREFIXES = 4
IMAGE_SUFFIX = r"r'\.(jpg|jpeg|png|webp|bmp|gif)$'"
NULL_WORDS = "('', 'none', 'null')"


def normalize_path(x: str) -> str:
    """Stripped, NFC, forward slashes only, no ``//``, no leading dots or slashes."""
    text = nfc(f"translate({strip(x)}, '\\\\', '/')")
    return f"trim(LEADING './' FROM regexp_replace({text}, '/{{2,}}', '/'))"


def path_variants(x: str) -> str:
    """Spellings of one path to try, in order, without blanks or repeats."""

    def spell(n: str) -> str:
        out = [n, strip(x)]
        for _ in range(MAX_TURN_PREFIXES):
            n = f"regexp_replace({n}, {TURN_PREFIX}, '')"
            out.append(n)
        return f"array_distinct(filter(array({', '.join(out)}), v -> v <> ''))"

    return let(normalize_path(x), "n", spell)


def collapse_path(x: str) -> str:
    """Drop ``.`` and empty segments; a leading slash stays."""
    inner = rf"regexp_replace({x}, r'/(?:\.?/)+', '/')"
    return rf"regexp_replace(regexp_replace({inner}, r'/\.?$', ''), r'^\.(?:/|$)', '')"


def canonical_path(x: str) -> str:
    """``collapse_path`` plus ``..``; a path that climbs out keeps its leading ``..``."""
    climb = """aggregate(split(q, '/'), CAST(array() AS array<string>), (done, seg) -> CASE
        WHEN seg <> '..' THEN array_append(done, seg)
        WHEN done = array('') THEN done
        WHEN size(done) > 0 AND element_at(done, -1) <> '..' THEN slice(done, 1, size(done) - 1)
        ELSE array_append(done, seg) END)"""
    return let(
        collapse_path(x),
        "q",
        lambda q: rf"CASE WHEN {q} RLIKE r'(^|/)\.\.(/|$)' THEN array_join({climb}, '/') ELSE {q} END",
    )


def dir_name(x: str) -> str:
    """Everything up to and including the last slash."""
    return f"left({x}, length({x}) - length({base_name(x)}))"


def base_name(x: str) -> str:
    return f"substring_index({x}, '/', -1)"


def substitute_paths(x: str, rules: Sequence[tuple[str, str]]) -> str:
    """Apply (old, new) rules in order, each to its first occurrence only."""
    for old, new in rules:
        if old and new:
            find, put = text_literal(old), text_literal(new)
            x = let(
                x,
                "s",
                lambda s: f"IF(contains({s}, {find}), overlay({s} PLACING {put} FROM instr({s}, {find}) FOR {len(old)}), {s})",
            )
    return x


def parse_rules(items: Sequence[str]) -> list[tuple[str, str]]:
    """``OLD:NEW`` strings to rules; the first colon splits and OLD must not be empty."""
    rules = []
    for item in items:
        old, colon, new = item.partition(":")
        if not (old and colon):
            raise ValueError(f"expected OLD:NEW, got {item!r}")
        rules.append((old, new))
    return rules


def prepend_subdir(x: str, subdir: str) -> str:
    """Put bare file names under ``subdir``, an expression; ``./a`` counts as bare."""
    folder = collapse_path(strip(subdir))
    bare = collapse_path(strip(x))
    joined = f"concat_ws('/', nullif({folder}, ''), nullif({bare}, ''))"
    return f"CASE WHEN {strip(subdir)} <> '' AND NOT contains({bare}, '/') THEN {joined} ELSE {x} END"


def root_prefix(x: str) -> str:
    return f"split_part(btrim({x}, '/'), '/', 1)"


def is_basename_only(x: str) -> str:
    return f"(NOT contains(btrim({x}, '/'), '/') AND lower(btrim({x}, '/')) RLIKE {IMAGE_SUFFIX})"


def null_path(x: str) -> str:
    """Stripped path, or null where it is blank or spells none/null."""
    return f"CASE WHEN lower({strip(x)}) NOT IN {NULL_WORDS} THEN {strip(x)} END"


def glob_to_regex(pattern: str) -> str:
    """Shell glob as an anchored Java regex; ``*`` also crosses ``/``."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        i += 1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[" and (end := pattern.find("]", i + (2 if pattern[i : i + 1] == "!" else 1))) > 0:
            body, i = pattern[i:end], end + 1
            negate = body.startswith("!")
            body = "".join(x if x.isalnum() or x == "-" else "\\" + x for x in body[negate:])
            out.append(f"[{'^' * negate}{body}]")
        else:
            out.append(ch if ch.isalnum() or ord(ch) > 127 else "\\" + ch)
    return r"(?s)\A" + "".join(out) + r"\z"
