"""Text, path, naming and image functions.

Each takes a SQL expression, such as a column name, and returns a SQL
expression, for use with ``selectExpr`` and ``F.expr``. Expressions built this
way cost one call to the JVM each, however deep they nest.
"""


def text_literal(text: str) -> str:
    """SQL literal of a Python string."""

    def escaped(c: str) -> str:
        return f"\\u{ord(c):04x}" if ord(c) <= 0xFFFF else f"\\U{ord(c):08x}"

    return "'" + "".join(c if c.isascii() and c.isalnum() else escaped(c) for c in text) + "'"
