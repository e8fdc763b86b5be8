"""Language identification by compression.

A language is a zstandard dictionary of raw content: excerpts of labelled texts behind
each other. A text is encoded with every dictionary and belongs to the language that
encodes it in the fewest bytes; when the next best is nearly as short, the margin is
narrow and the answer is marked as rejected. Only letters count: texts are lowered and
everything else becomes single blanks, so shouting, numbers and marks change nothing.
Long texts are encoded in pieces, because a dictionary says little about what follows
many bytes of the text itself.

What is learned is a sample with fixed bounds (``Sampling``), so the model has the same
size however large the corpus is; every text is then judged whole.

Rows: a text without any letter, null and empty ones included, is ``und`` with score 0.
Equal sizes go to the language with more labelled texts, then the smaller name. Rows
without a label are not learned from. Copies of a text are learned once. Without
anything to learn from, every text is ``und``. Repeated rows and null ids are judged
like others. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import by_size

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[by_size.__module__])

UNKNOWN = "und"
LEVEL = 9
PIECE_BYTES = 1500
NARROW = 0.02


@dataclass(frozen=True)
class Sampling:
    """Bounds of what is learned from.

    ``excerpts`` texts of each language, ``letters`` characters of each, of the
    ``languages`` with the most labelled texts. Texts are chosen by their hash.
    """

    excerpts: int = 256
    letters: int = 400
    languages: int = 64


def letters_of(text: Column) -> Column:
    """The lowered letters of a text, runs of anything else as one blank."""
    return F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def learn(
    labelled: DataFrame, lang: str = "lang", text: str = "text", sampling: Sampling = Sampling()
) -> dict[str, bytes]:
    """Dictionary of each language, languages with more labelled texts first."""
    whole, label = F.col(text).cast("string"), F.col(lang).cast("string")
    rows = labelled.select(label.alias("lang"), whole.alias("text")).where(
        F.col("lang").isNotNull() & F.rlike("text", F.lit(r"\p{L}"))
    )
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    first = counts.orderBy(F.col("n").desc(), "lang").limit(sampling.languages).collect()
    if not first:
        return {}
    known = labelled.sparkSession.createDataFrame(first, counts.schema)
    # More than needed by hash, then the least hashes of those.
    mark = F.xxhash64("text")
    share = F.pmod(mark, F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = (
        rows.join(F.broadcast(known), "lang")
        .where(share * F.col("n") < 8 * sampling.excerpts)
        .withColumn("mark", mark)
        .withColumn("letters", letters_of(F.col("text")))
        .withColumn("room", F.greatest(F.length("letters") - sampling.letters, F.lit(0)) + 1)
        .withColumn("start", F.pmod(F.xxhash64(F.lit(1), "text"), "room").cast("int") + 1)
        .select("lang", "mark", F.substr("letters", F.col("start"), F.lit(sampling.letters)).alias("part"))
        .distinct()
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("mark", "part"))
    chosen = some.withColumn("place", place).where(F.col("place") <= sampling.excerpts)
    parts: dict[str, list[str]] = {row.lang: [] for row in first}
    for row in chosen.orderBy("lang", "place").collect():
        parts[row.lang].append(row.part)
    return {name: " ".join(texts).encode() for name, texts in parts.items() if texts}


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    table = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    table.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=table, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def _judge(text: str, compressors: list[zstandard.ZstdCompressor]) -> tuple[int, float]:
    """Place of the language with the fewest bytes, and by how much the next one is longer."""
    data = text.encode()
    pieces = [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
    sizes = [sum(len(c.compress(piece)) for piece in pieces) for c in compressors]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    others = sizes[:best] + sizes[best + 1 :]
    return best, (min(others) - sizes[best]) / min(others) if others else 1.0


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    key: str = "doc_id",
    text: str = "text",
    narrow: float = NARROW,
) -> DataFrame:
    """doc_id, lang, score, rejected for each row.

    ``score`` is the margin to the next best language, as a share of its size;
    ``rejected`` is set where it is below ``narrow``, and where there is no language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(shared.value)
        compressors = [_compressor(content) for content in shared.value.values()]
        for batch in by_size(batches, "letters"):
            langs, scores = [], []
            for letters in batch.column(1).to_pylist():
                best, margin = _judge(letters, compressors) if letters and names else (None, 0.0)
                langs.append(UNKNOWN if best is None else names[best])
                scores.append(margin)
            columns = [
                batch.column(0),
                pa.array(langs, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array([s < narrow for s in scores], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "score", "rejected"])

    letters = letters_of(F.col(text).cast("string"))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), letters.alias("letters"))
    return rows.mapInArrow(judge, "doc_id long, lang string, score double, rejected boolean")
