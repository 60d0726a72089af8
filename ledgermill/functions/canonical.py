"""JSON as Python's standard library writes it (sorted keys, no blanks, text as it is, numbers in the library's own form),
and content hashes over it. The JVM's variants print 1.50 as 1.5 and 1.0 as 1, so values with such numbers come here."""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as S

_MAY_BE_JSON = re.compile(r'[ \t\n\r]*[\[{"tfnNI0-9-]')
#: Text whose JSON the JVM may print otherwise: fractions, exponents, long or negative-zero numbers, words for no numbers, and
#: characters by their numbers.
ODD = r"[0-9][.eE]|[0-9]{16}|-0|NaN|Infinity|\\u"


def dumped(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def canonical(text: str | None) -> str | None:
    """A JSON text in canonical form; null for any other text."""
    if text is None or not _MAY_BE_JSON.match(text):
        return None
    try:
        out = dumped(json.loads(text))
        out.encode()  # half of a surrogate pair is no text
        return out
    except (ValueError, RecursionError):
        return None


def token(text: str | None) -> str:
    """How a value counts in content hashes: JSON as such, other text without case and spacing."""
    if text is None:
        return "null"
    found = canonical(text)
    return dumped(" ".join(text.split()).casefold()) if found is None else found


@F.arrow_udf(S.StringType())
def exact_json(texts: pa.Array) -> pa.Array:
    return pa.array([canonical(t) for t in texts.to_pylist()], pa.string())


def canonical_json(c: Column) -> Column:
    """Canonical JSON of a JSON text, null for any other. Only texts with odd numbers leave the JVM."""
    t = c.cast("string")
    odd = F.coalesce(t.rlike(ODD), F.lit(False))
    return F.coalesce(F.when(~odd, F.to_json(F.try_parse_json(t))), exact_json(F.when(odd, t)))


def _tokens(values: pa.Array) -> list[str]:
    """token() of each value: once for each distinct one of a batch, as most fields of most records are null or repeat."""
    if values.null_count == len(values):
        return ["null"] * len(values)
    coded = values.dictionary_encode()
    known = [token(v) for v in coded.dictionary.to_pylist()]
    return ["null" if i is None else known[i] for i in coded.indices.to_pylist()]


@F.arrow_udf(S.StringType())
def _hashed(fields: pa.Array) -> pa.Array:
    names = [f'"{field.name}":' for field in fields.type]
    columns = [_tokens(c) for c in fields.flatten()]
    return pa.array([hashlib.sha256(("{" + ",".join(n + t for n, t in zip(names, row)) + "}").encode()).hexdigest() for row in zip(*columns)], pa.string())


def content_hash(fields: tuple[str, ...]) -> Column:
    """SHA-256 over the tokens of fields, sorted by name. One call for all fields of a batch: as expressions of the JVM, 27 of them
    were planned for seconds and took fifty times as long."""
    return _hashed(F.struct(*(F.col(f).cast("string").alias(f) for f in sorted(fields))))
