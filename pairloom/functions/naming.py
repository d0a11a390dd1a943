"""Names of samples, shards and slice folders."""

from pairloom.functions import text_literal
from pairloom.functions.text import strip

KEY_HASH_CHARS = 20


def stem_of(file: str) -> str:
    return rf"regexp_replace({file}, r'\.parquet$', '')"


def sample_key(stem: str, index: str, prompt: str) -> str:
    """Stem, zero-padded index and a short hash of stem, index and prompt."""
    digest = f"sha2(concat_ws('\\u0000', {stem}, CAST({index} AS STRING), {prompt}), 256)"
    return f"format_string('%s_%08d_%s', {stem}, {index}, left({digest}, {KEY_HASH_CHARS}))"


def shard_name(shard_id: str, prefix: str = "''") -> str:
    body = f"format_string('shard-%05d.tar', {shard_id})"
    return f"concat_ws('-', nullif({strip(prefix)}, ''), {body})"


def slice_layout(out: str, stem: str) -> str:
    """Folder that takes the shards of one slice."""
    return f"concat({text_literal(out.rstrip('/') + '/')}, {stem}, '/')"
