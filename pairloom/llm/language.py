"""Language identification by compression with a zstandard dictionary per language.

A text is compressed with every language's raw-content dictionary, in pieces, so
that long texts cannot become their own dictionary; the smallest total wins.
"""

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.memory import released
from pairloom.llm.words import chunks

DICTIONARY_BYTES = 128_000
SAMPLE_ROWS = 400  # labelled rows a language that are read for its dictionary
EXCERPT_CHARS = 4096  # letters of each of these rows, from places all over it
PLACES = 8
PIECE_CHARS = 1000
SHORT_BYTES = 256
MARGIN = 0.005  # of the second smallest size; a narrower win is rejected
TEMPERATURE = 0.02
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def letters(text: str) -> str:
    return " ".join(_LETTERS.findall(text.lower()))


def _excerpt() -> Column:
    """The letters of ``text``, or of a long one pieces from its beginning to its end."""
    clean, each = F.regexp_replace("text", "[^\\p{L}]+", " "), EXCERPT_CHARS // PLACES
    steps = [F.floor((F.length(clean) - each) * (i / (PLACES - 1))).cast("int") + 1 for i in range(PLACES)]
    return F.when(F.length(clean) <= EXCERPT_CHARS, clean).otherwise(F.concat_ws(" ", *[F.substring(clean, at, F.lit(each)) for at in steps]))


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> dict[str, bytes]:
    """Dictionaries from ``text`` and ``lang``: ``rows`` different texts a language, those with the smallest hashes, so that no source or task is preferred.

    Rows without text or language teach nothing; no rows give no dictionaries.
    """
    use = labelled.select("lang", "text", F.shiftrightunsigned(F.xxhash64("text", F.lit(3)), 1).alias("h")).where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    counts = {r.lang: r.n for r in use.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    sample, top = [], {lang: 1.5 * rows / max(1, n) for lang, n in counts.items()}  # a little more than wanted
    while top:
        limits = F.create_map(*[F.lit(x) for lang, share in top.items() for x in (lang, min((1 << 63) - 1, int(share * (1 << 63))))])
        got = use.where(F.col("h") <= F.element_at(limits, F.col("lang"))).select("lang", "h", _excerpt().alias("text")).distinct().collect()
        by = {lang: list(group) for lang, group in groupby(sorted(got, key=lambda r: (r.lang, r.h, r.text)), key=lambda r: r.lang)}
        done = [lang for lang, share in top.items() if share >= 1 or len(by.get(lang, [])) >= rows]
        sample += [r for lang in done for r in by.get(lang, [])[:rows]]
        top = {lang: 4 * share for lang, share in top.items() if lang not in done}
    found = {}
    for lang, group in groupby(sorted(sample, key=lambda r: (r.lang, r.h, r.text)), key=lambda r: r.lang):
        found[lang] = "\n".join(letters(r.text) for r in group).encode()[:DICTIONARY_BYTES]
    return {lang: content for lang, content in found.items() if content}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        usual = zstandard.ZstdCompressionParameters.from_level(6, **plain)
        fine = zstandard.ZstdCompressionParameters(window_log=18, chain_log=18, hash_log=17, search_log=7, min_match=3, target_length=256, strategy=zstandard.STRATEGY_BTLAZY2, **plain)
        make = lambda lang, how: zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how)
        self.usual = [make(lang, usual).compress for lang in self.langs]
        self.fine = [make(lang, fine).compress for lang in self.langs]

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes by language. Short texts are searched finely, and mirrored word by word, since zstandard stores what saves too little."""
        clean = letters(text)
        if len(clean.encode()) < SHORT_BYTES:
            words = clean.split()
            piece = " ".join(words + words[::-1]).encode()
            return [len(f(piece)) for f in self.fine]
        pieces = [clean[i : i + PIECE_CHARS].encode() for i in range(0, len(clean), PIECE_CHARS)]
        return [sum(len(f(p)) for p in pieces) for f in self.usual]

    def classify(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, margin, and whether it is rejected."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0, True
        sizes = np.array(self.sizes(text), dtype=float)
        order = np.argsort(sizes, kind="stable")
        margin = float((sizes[order[1]] - sizes[order[0]]) / sizes[order[1]]) if len(sizes) > 1 else 1.0
        score = 1.0 / float(np.exp(-(sizes - sizes[order[0]]) / sizes[order[0]] / TEMPERATURE).sum())
        return self.langs[order[0]], score, margin, margin < MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], keep: list[str]) -> DataFrame:
    """``keep`` columns and lang_pred, score, margin, rejected, from ``text`` alone.

    Null texts and texts without a letter are ``und``, score 0 and rejected; equal
    sizes go to the first language by name and are rejected. Repeated rows stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(dictionaries)
        for whole in batches:
            for batch in chunks(whole, "__text"):
                rows = [model.classify(t) for t in batch.column("__text").to_pylist()]
                found = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *found], names=[*keep, "lang_pred", "score", "margin", "rejected"])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(released(run), f"{schema}, lang_pred string, score double, margin double, rejected boolean")

