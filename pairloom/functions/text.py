"""Unicode text functions that stay on the JVM.

Spark SQL has no NFC and no full case folding, but it ships ICU and can call
static methods by name. The calls sit behind a test for non-ASCII text, so
plain paths never pay for them.
"""

from collections.abc import Callable

from pairloom.functions import text_literal

# Every character Python's str.strip() removes; Spark's trim() knows only the space.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(x: str) -> str:
    return f"btrim({x}, {text_literal(WHITESPACE)})"


def _icu(x: str, method: str, flag: str, plain: str) -> str:
    owner, _, name = method.rpartition(".")
    wide = f"octet_length({x}) <> char_length({x})"
    return f"CASE WHEN {wide} THEN reflect('com.ibm.icu.{owner}', '{name}', {x}, {flag}) ELSE {plain} END"


def nfc(x: str) -> str:
    """Unicode normal form C."""
    return _icu(x, "text.Normalizer.compose", "false", x)


def casefold(x: str) -> str:
    """Full Unicode case folding: 'ß' becomes 'ss', which lower() does not do."""
    return _icu(x, "lang.UCharacter.foldCase", "true", f"lower({x})")


def let(x: str, name: str, body: Callable[[str], str]) -> str:
    """Evaluate ``x`` once and use it several times in ``body``."""
    return f"transform(array({x}), {name} -> {body(name)})[0]"
