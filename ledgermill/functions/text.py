"""Column functions for text, numbers, dates and JSON. All are built-in expressions; what can't be parsed becomes null or
stays text, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .canonical import canonical_json

BLANKS = r"[\s\u001c-\u001f\u0085   -     　]"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def first_value(*columns: Column) -> Column:
    """The first that is neither null nor empty; blanks count as a value."""
    return F.coalesce(*(F.nullif(c.cast("string"), F.lit("")) for c in columns), F.lit(None).cast("string"))


def text(c: Column) -> Column:
    """Without leading and trailing white space; blank becomes null."""
    return F.nullif(F.regexp_replace(c.cast("string"), f"^{BLANKS}+|{BLANKS}+$", ""), F.lit(""))


def first_text(*columns: Column) -> Column:
    return text(first_value(*columns))


def description_text(c: Column) -> Column:
    """text() with line feeds for all line ends."""
    return F.replace(F.replace(text(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def clean_text(c: Column) -> Column:
    """Runs of white space become one space, none at the ends; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), f"{BLANKS}+", " "))


def casefold_key(c: Column) -> Column:
    """clean_text() for comparisons without case, by full case folding: 'ß' is 'ss', a closing sigma a sigma. Upper and
    then lower case gives that but for the dotless i, which is kept apart (and Cherokee, in small letters here)."""
    upper = F.replace(F.upper(F.translate(clean_text(c), "ı", "\ue000")), F.lit("ẞ"), F.lit("SS"))
    return F.translate(F.lower(upper), "ς\ue000", "σı")


def integer(c: Column) -> Column:
    """The digits of the first number-like run, separators dropped: 'Over 1,200' is 1200."""
    run = F.regexp_extract(c.cast("string"), r"-?\d[\d\s,.]*", 0)
    return F.nullif(F.regexp_replace(run, r"[^\d-]", ""), F.lit("")).try_cast("bigint")


def _plain(number: Column) -> Column:
    digits = number.cast("string")
    return F.when(digits.contains("."), F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", "")).otherwise(digits)


def decimal_text(c: Column) -> Column:
    """A number in plain notation without trailing zeros; commas are dropped, NaN and infinities null, other text stays."""
    t = F.trim(F.replace(c.cast("string"), F.lit(","), F.lit("")))
    number = t.try_cast("decimal(38,18)")
    odd = F.lower(t).rlike("^[+-]?(nan|inf|infinity)$")
    return F.when(first_value(c).isNull() | odd, F.lit(None)).otherwise(F.coalesce(F.when(number == 0, "0").otherwise(_plain(number)), text(c)))


def json_number(c: Column) -> Column:
    """The token of a number in JSON, or else the text as a JSON string; null stays null."""
    t = c.cast("string")
    number = t.try_cast("decimal(38,18)")
    quoted = F.regexp_extract(F.to_json(F.struct(t.alias("v"))), r'^\{"v":(.*)\}$', 1)
    return F.when(first_value(c).isNotNull(), F.coalesce(F.when(number == 0, "0").otherwise(_plain(number)), quoted))


def format_number(c: Column) -> Column:
    """Whole numbers with spaces between thousands, others plain; other text as it is."""
    t = c.cast("string")
    number = t.try_cast("decimal(38,18)")
    whole = F.replace(F.format_number(number.cast("decimal(38,0)"), 0), F.lit(","), F.lit(" "))
    return F.coalesce(F.when(number == F.floor(number), whole).otherwise(_plain(number)), t)


#: Words of salary labels: fixed values.
SALARY_WORDS = {"en": {"from": "from", "to": "up to"}, "ru": {"from": "от", "to": "до"}}
INTERVALS_RU = {"hour": "час", "day": "день", "week": "неделю", "month": "месяц", "year": "год"}


def lookup(c: Column, table: dict[str, str], default: Column) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[c], default)


def salary_label(low: Column, high: Column, currency: Column, interval: Column, salary_text: Column, language: str = "en") -> Column:
    words = SALARY_WORDS[language]
    per = F.lower(F.coalesce(interval, F.lit("")))
    per = lookup(per, INTERVALS_RU, per) if language == "ru" else per
    amount = (
        F.when(low.isNotNull() & high.isNotNull(), F.concat(format_number(low), F.lit("–"), format_number(high)))
        .when(low.isNotNull(), F.concat(F.lit(words["from"] + " "), format_number(low)))
        .otherwise(F.concat(F.lit(words["to"] + " "), format_number(high)))
    )
    suffix = F.concat_ws(" ", F.nullif(F.upper(F.coalesce(currency, F.lit(""))), F.lit("")), F.when(per != "", F.concat(F.lit("/ "), per)))
    return F.when(low.isNull() & high.isNull(), F.coalesce(salary_text, F.lit(""))).otherwise(F.trim(F.concat_ws(" ", amount, suffix)))


def csv_safe_cell(c: Column) -> Column:
    """Null becomes empty; what a spreadsheet would read as a formula gets an apostrophe."""
    t = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(t.rlike(f"^{BLANKS}*[=+\\-@]|^[\\t\\r\\n]"), F.concat(F.lit("'"), t)).otherwise(t)


def date_part(c: Column) -> Column:
    return F.substring(F.coalesce(text(c), F.lit("")), 1, 10)


def instant(c: Column) -> Column:
    """The instant of an ISO date or time; without an offset it is UTC (the session's zone must be). Else null."""
    t = c.cast("string")
    return F.when(t.rlike(ISO_TIME), F.try_to_timestamp(t))


def iso_value(c: Column) -> Column:
    """Times in UTC to the second; texts of 10 characters and of unknown form as they are; blank null."""
    t = text(c)
    return F.when(F.length(t) == 10, t).otherwise(F.coalesce(F.date_format(instant(t), "yyyy-MM-dd'T'HH:mm:ss'Z'"), t))


def parse_date(c: Column, today: Column) -> Column:
    """A date from ISO text (its own date, whatever the offset) or from a phrase such as '3 days ago', in English or
    Russian, counted back from today; else null."""
    t = F.lower(text(c))
    n = F.coalesce(F.nullif(F.regexp_extract(t, r"\d+", 0), F.lit("")).try_cast("int"), F.lit(0))
    count = F.when(n == 0, 1).otherwise(n)
    back = (
        F.when(t.rlike("hour|час|today|сегодня"), today)
        .when(t.rlike("day|дн"), F.date_sub(today, count))
        .when(t.rlike("week|нед"), F.date_sub(today, count * 7))
    )
    return F.coalesce(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(t, 1, 10).try_cast("date")), back)


def quoted(c: Column) -> Column:
    """A string as JSON; null stays null."""
    return F.when(c.isNotNull(), F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1))


def json_text(c: Column) -> Column:
    """Canonical JSON: parsed text with sorted keys, else the text as a JSON string; blank null."""
    t = text(c)
    return F.when(t.isNotNull(), F.coalesce(canonical_json(t), quoted(t)))


def decode_json(c: Column) -> Column:
    """JSON text as canonical text; blank null; anything else as it is."""
    return F.when(first_value(c).isNotNull(), F.coalesce(canonical_json(c), c))


def hash_token(c: Column) -> Column:
    """How a value counts in content hashes: parsed JSON as such, other text without case and spacing; null is null."""
    t = c.cast("string")
    looks = t.rlike(r'^\s*([\[{"tfnNI0-9-])')  # all else can't be JSON
    return F.when(t.isNull(), F.lit("null")).otherwise(F.coalesce(canonical_json(F.when(looks, t)), quoted(casefold_key(t))))
