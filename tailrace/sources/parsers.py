"""Payload parsers as SQL table functions, whose columns follow from their arguments.

    register_parser(spark, "words_of", split_at_spaces)
    spark.sql("SELECT topic, word, n FROM words_of(TABLE(SELECT topic, payload FROM recs), 'word string, n bigint')")

The rows keep all columns but ``payload``. For parts that SQL can express, ``parse_payload`` is faster, as it stays in the JVM.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

# Takes a payload and the names asked for; gives a row of values per record in it, in their order.
Parser = Callable[[bytes, Sequence[str]], Iterable[Sequence]]


def split_at_spaces(payload: bytes, names: Sequence[str]) -> Iterable[Sequence]:
    """Parts of a UTF-8 payload divided by single spaces, one record per payload; what is missing is null."""
    words = payload.decode("utf-8", "replace").split(" ")
    yield [words[i] if i < len(words) else None for i in range(len(names))]


def json_lines(payload: bytes, names: Sequence[str]) -> Iterable[Sequence]:
    """One record per line that holds a JSON object; other lines give none."""
    for line in payload.split(b"\n"):
        try:
            value = json.loads(line)
        except ValueError:
            continue
        if isinstance(value, dict):
            yield [value.get(n) for n in names]


def fields_of(text: str) -> list[tuple[str, str]]:
    """Names and types of ``'word string, n bigint'``."""
    fields = [tuple(part.split()) for part in text.split(",")]
    if any(len(f) != 2 or f[1].lower() not in _TYPES for f in fields):
        raise ValueError(f"fields {text!r} are not of the form 'name type, …' with types {', '.join(_TYPES)}")
    return [(name, kind.lower()) for name, kind in fields]


def register_parser(spark: SparkSession, name: str, parser: Parser) -> None:
    """Make ``parser`` the SQL function ``name(TABLE(rows with a payload), 'field type, …')``.

    A payload may hold several records or none. An absent payload counts as empty; values that do not fit the type
    asked for become null. The table is not shuffled: each task parses the rows it reads.
    """

    class Parse:
        @staticmethod
        def analyze(rows: AnalyzeArgument, fields: AnalyzeArgument) -> AnalyzeResult:
            if not rows.isTable or "payload" not in rows.dataType.names:
                raise ValueError(f"{name} takes a table with a column payload")
            if not fields.isConstantExpression or fields.value is None:
                raise ValueError(f"the fields of {name} must be a constant string")
            asked = [T.StructField(n, _TYPES[kind][0]) for n, kind in fields_of(fields.value)]
            kept = [f for f in rows.dataType.fields if f.name != "payload"]
            clash = {f.name for f in kept} & {f.name for f in asked}
            if clash:
                raise ValueError(f"{name}: columns {sorted(clash)} are in the table and among the fields")
            return AnalyzeResult(T.StructType([T.StructField(f.name, f.dataType) for f in kept] + asked))

        def eval(self, row, fields):
            asked = fields_of(fields)
            names, casts = [n for n, _ in asked], [_TYPES[kind][1] for _, kind in asked]
            kept = [v for n, v in zip(row.__fields__, row) if n != "payload"]
            for values in parser(bytes(row["payload"] or b""), names):
                yield (*kept, *(cast(v) for cast, v in zip(casts, values, strict=True)))

    spark.udtf.register(name, udtf(Parse))


def _whole(value):
    if isinstance(value, str):
        value = int(value) if re.fullmatch("[+-]?[0-9]{1,19}", value) else None
    fits = isinstance(value, int) and not isinstance(value, bool) and -(2**63) <= value < 2**63
    return value if fits else None


def _real(value):
    if isinstance(value, bool) or not isinstance(value, (int, float, str)):
        return None
    try:
        return float(value)
    except (ValueError, OverflowError):
        return None


def _text(value):
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _bytes(value):
    return value.encode() if isinstance(value, str) else value if isinstance(value, bytes) else None


_TYPES = {
    "string": (T.StringType(), _text),
    "bigint": (T.LongType(), _whole),
    "double": (T.DoubleType(), _real),
    "binary": (T.BinaryType(), _bytes),
}
