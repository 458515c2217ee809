"""Fill-in-middle: a document cut in three, with its middle moved to the end."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelabel.llm.common import python_columns

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class FimParams:
    """`rate` percent of the documents are transformed, `spm` percent of those put the suffix first."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    @property
    def sentinels(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix, self.suffix, self.middle


def line_ends(text: bytes | bytearray) -> np.ndarray:
    """Where each line ends, its line feed included; a last line may do without."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not len(text) or text[-1:] == b"\n" else np.append(ends, len(text))


def code_points(text: bytes | bytearray) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def _reverse(text: bytearray, begin: int, end: int) -> None:
    text[begin:end] = text[begin:end][::-1]


def exchange(text: bytearray, begin: int, cut: int, end: int) -> None:
    """Swap the neighbouring blocks [begin, cut) and [cut, end) by three reversals."""
    _reverse(text, begin, cut)
    _reverse(text, cut, end)
    _reverse(text, begin, end)


def rotated(text: bytes, cuts: tuple[int, int], form: str, params: FimParams) -> bytearray:
    """The text with sentinels in front of its three parts, and the blocks exchanged as `form` says."""
    first, second = cuts
    out = bytearray(text)
    # From the back, so that the earlier cuts stay where they are.
    out[second:second] = params.suffix
    out[first:first] = params.middle
    out[:0] = params.prefix
    middle = len(params.prefix) + first
    suffix = second + len(params.prefix) + len(params.middle)
    exchange(out, middle if form == PSM else 0, suffix, len(out))
    return out


def unrotated(output: bytes, form: str, params: FimParams) -> bytearray:
    """The text that `rotated` was given: the rotation taken back, the sentinels taken out.

    A text with a sentinel is never rotated, and the end of one part cannot form a sentinel with
    the next sentinel, so the first place of each is its own.
    """
    out = bytearray(output)
    if form == PLAIN:
        return out
    begin = out.find(params.suffix)
    after = out.find(params.middle if form == PSM else params.prefix, begin)
    exchange(out, begin, after, len(out))
    for sentinel in params.sentinels:
        at = out.find(sentinel)
        del out[at:at + len(sentinel)]
    return out


def fill_in_middle(
    docs: DataFrame, params: FimParams = FimParams(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: the id, n, form, prefix_chars, middle_chars, output.

    `n` is the number of lines. The two cuts lie after a number of lines drawn from a hash of seed
    and id; `form` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle) and
    `output` the text in that form. Empty texts and texts that hold a sentinel stay plain, with
    null for prefix_chars and middle_chars.

    Null text counts as empty, a null id as an empty one. Rows that repeat an id are cut by the same
    draws, each in its own lines. A very long text is one row in memory, with a few copies of
    itself. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    name = F.concat(F.lit(f"{params.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    draws = {f"h{i + 1}": F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)}

    inputs = ("text", *draws)

    def make() -> Callable:
        def cut(text: bytes, h1: int, h2: int, h3: int, h4: int) -> tuple:
            ends = line_ends(text)
            n = len(ends)
            if not n or any(s in text for s in params.sentinels) or h3 % 100 >= params.rate:
                return n, PLAIN, None, None, text
            first, second = (int(ends[i - 1]) if i else 0 for i in sorted((h1 % (n + 1), h2 % (n + 1))))
            form = SPM if h4 % 100 < params.spm else PSM
            out = rotated(text, (first, second), form, params)
            return n, form, code_points(text[:first]), code_points(text[first:second]), bytes(out)

        def compute(batch: dict[str, pa.Array]) -> dict[str, pa.Array]:
            rows = [cut(*row) for row in zip(*(batch[c].to_pylist() for c in inputs))]
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            names = ("n", "form", "prefix_chars", "middle_chars", "output")
            return {k: pa.array(c, t) for k, c, t in zip(names, columns, types)}

        return compute

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    done = python_columns(
        docs, make, "n long, form string, prefix_chars long, middle_chars long, output binary",
        {"text": text, **draws}, [id_col])
    return done.withColumn("output", F.col("output").cast("string"))


def restore(
    rows: DataFrame, params: FimParams = FimParams(), output_col: str = "output", form_col: str = "form",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """`keep` columns and `text`: what `fill_in_middle` was given, from its output and form alone.

    Null output gives the empty text, null form counts as plain.
    """
    def make() -> Callable:
        def compute(batch: dict[str, pa.Array]) -> dict[str, pa.Array]:
            pairs = zip(batch["output"].to_pylist(), batch["form"].to_pylist())
            return {"text": pa.array([bytes(unrotated(o, f, params)) for o, f in pairs], pa.binary())}

        return compute

    inputs = {
        "output": F.coalesce(F.col(output_col), F.lit("")).cast("binary"),
        "form": F.coalesce(F.col(form_col), F.lit(PLAIN))}
    done = python_columns(rows, make, "text binary", inputs, list(keep))
    return done.withColumn("text", F.col("text").cast("string"))
