"""Fill-in-the-middle examples: a text cut at two unit borders and put in another order.

A unit is a word with the white space before it, or white space at the end of the text.
One ``fullmatch`` of (unit)* with the regex library keeps the end of every repetition:
their number is the number of units and the cuts are looked up in them. A long text is
matched in parts, each of which ends where a unit does, so that the captures held at a
time are bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallychain.llm.tables import each_text, map_rows

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Per cent of the texts that are cut, and of those the ones in suffix-prefix-middle order.
RATE, SPM_RATE = 50, 80
#: Code points matched at a time.
PART_CHARS = 1 << 20
#: Texts handed on at a time, in code points.
_OUT_CHARS = 1 << 22

_UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")
_BORDER = regex.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")


def unit_ends(text: str, part: int = PART_CHARS) -> Iterator[list[int]]:
    """The end of every unit of ``text``, in lists of about ``part`` code points each."""
    start = 0
    while start < len(text):
        border = _BORDER.search(text, start + part) if len(text) - start > part else None
        end = border.start() if border else len(text)
        yield _UNITS.fullmatch(text, start, end).ends(1)
        start = end


def cuts(text: str, draws: tuple[int, int], part: int = PART_CHARS) -> tuple[int, int, int]:
    """(n, first, second): the number of units and both cut offsets that ``draws`` stand for."""
    if len(text) <= part:
        ends = _UNITS.fullmatch(text).ends(1)
        n = len(ends)
        low, high = sorted(d % (n + 1) for d in draws)
        return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0
    n = sum(len(ends) for ends in unit_ends(text, part))
    wanted = sorted(d % (n + 1) for d in draws)
    found, before = [0, 0], 0
    for ends in unit_ends(text, part):
        for i, k in enumerate(wanted):
            if before < k <= before + len(ends):
                found[i] = ends[k - before - 1]
        before += len(ends)
    return n, *found


def draws_of(doc_id: int | None, seed: int = SEED) -> tuple[int, ...]:
    """Four unsigned 32-bit numbers of a document; a null id is an empty one."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def arrange(
    doc_id: int | None, text: str, rate: int, spm_rate: int, seed: int
) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output)."""
    h1, h2, h3, h4 = draws_of(doc_id, seed)
    n, first, second = cuts(text, (h1, h2))
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    head, body, tail = text[:first], text[first:second], text[second:]
    if h4 % 100 < spm_rate:
        return n, "spm", len(head), len(body), f"{SUFFIX}{tail}{PREFIX}{head}{MIDDLE}{body}"
    return n, "psm", len(head), len(body), f"{PREFIX}{head}{SUFFIX}{tail}{MIDDLE}{body}"


_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(
    docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``.

    ``form`` is psm, spm or plain; a plain output is the text itself. Empty texts and
    texts that contain a marker are plain. A null text is an empty one with no units, a
    null id draws like an empty one. Rows are independent: repeated rows give repeated
    results, an empty table gives an empty one, and other columns are ignored.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for doc_id, text in zip(batch.column(0).to_pylist(), each_text(batch.column(1))):
            made = arrange(doc_id, (text or b"").decode(), rate, spm_rate, seed)
            rows.append((doc_id, *made))
            size += len(made[-1])
            if size > _OUT_CHARS:
                yield _batch(rows)
                rows, size = [], 0
        yield _batch(rows)

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), work, _SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 6
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text an output was made of, from ``form`` and ``output`` alone.

    No marker overlaps itself, so the first one found is the one that was set.
    """

    def taken(order: tuple[str, str, str]) -> str:
        one, two, three = order
        rest = f"substr({output}, {len(one) + 1})"
        first = f"substring_index({rest}, '{two}', 1)"
        later = f"substr({rest}, length({first}) + {len(two) + 1})"
        second = f"substring_index({later}, '{three}', 1)"
        third = f"substr({later}, length({second}) + {len(three) + 1})"
        parts = {one: first, two: second, three: third}
        return f"concat({parts[PREFIX]}, {parts[MIDDLE]}, {parts[SUFFIX]})"

    return F.expr(
        f"CASE {form} WHEN 'psm' THEN {taken((PREFIX, SUFFIX, MIDDLE))}"
        f" WHEN 'spm' THEN {taken((SUFFIX, PREFIX, MIDDLE))} ELSE {output} END"
    )
