"""Scalar text functions as Column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All characters for which Python's str.isspace() holds.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"

# Script ranges by language code, inclusive code points.
SCRIPTS: dict[str, list[tuple[int, int]]] = {
    "hi": [(0x0900, 0x097F)],
    "ta": [(0x0B80, 0x0BFF)],
    "ml": [(0x0D00, 0x0D7F)],
    "ur": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
}
#: For corpora in Latin script: plain ASCII letters, so that diacritics lower the share.
ASCII_SCRIPTS = {k: [(0x41, 0x5A), (0x61, 0x7A)] for k in ("en", "fr", "de", "es")}
LANGUAGE_NAMES = {"hi": "Hindi", "ur": "Urdu", "ta": "Tamil", "ml": "Malayalam"}


#: The same characters as a set.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip_ws(c: Column) -> Column:
    """Trim all Unicode white space, not only U+0020; no regex, so linear in the ends."""
    return F.btrim(c, F.lit(SPACES))


def tokens(c: Column) -> Column:
    """White-space tokens; an empty text has none."""
    return stripped_tokens(strip_ws(c))


def stripped_tokens(s: Column) -> Column:
    return F.when(F.length(s) == 0, F.array().cast("array<string>")).otherwise(F.split(s, f"{WS}+"))


def repeat_fraction(toks: Column) -> Column:
    """Share of tokens that repeat an earlier one; 0 without tokens."""
    return F.when(F.size(toks) == 0, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(toks)) / F.size(toks))


def norm_key(c: Column) -> Column:
    """Dedup key: lower case, single spaces."""
    return F.trim(F.regexp_replace(F.lower(c), f"{WS}+", " "))


def char_class(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


def letters_of(text: Column) -> Column:
    return F.regexp_replace(text, r"\P{L}+", "")


def script_share(letters: Column, language: Column, scripts: dict[str, list[tuple[int, int]]] = SCRIPTS) -> Column:
    """Share of letters in the language's script; 0 without letters or for an unknown
    language. ``letters`` should be a computed column, as it is used twice."""
    own = F.lit(None).cast("int")
    for code, ranges in scripts.items():
        own = F.when(language == code, F.length(F.regexp_replace(letters, f"[^{char_class(ranges)}]+", ""))).otherwise(own)
    return F.coalesce(F.when(F.length(letters) > 0, own / F.length(letters)), F.lit(0.0))


def script_confidence(text: Column, language: Column, scripts: dict[str, list[tuple[int, int]]] = SCRIPTS) -> Column:
    return script_share(letters_of(text), language, scripts)


def language_name(code: Column) -> Column:
    pairs = [F.lit(x) for kv in LANGUAGE_NAMES.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[code], code)


def with_answer(prompt: Column, expected: Column) -> Column:
    """The prompt, and on a new line the answer if there is one."""
    p = F.coalesce(prompt, F.lit(""))
    return F.when(F.coalesce(expected, F.lit("")) != "", F.concat(p, F.lit("\n"), expected)).otherwise(p)


def model_slug(c: Column) -> Column:
    return F.translate(c, "/:", "__")


def short_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def split_model(c: Column, providers: tuple[str, ...], default: str) -> Column:
    """(provider, model): the part before a colon counts only if it is registered."""
    head = F.split_part(c, F.lit(":"), F.lit(1))
    known = c.contains(":") & head.isin(*providers)
    return F.when(known, F.struct(head.alias("provider"), F.regexp_replace(c, r"(?s)^[^:]*:", "").alias("model"))).otherwise(F.struct(F.lit(default).alias("provider"), c.alias("model")))


def ensemble_judges(label: Column) -> Column:
    """Judges named in a label ``ensemble[m]:a,b``."""
    rest = F.when(label.contains(":"), F.regexp_replace(label, r"(?s)^[^:]*:", "")).otherwise("")
    return F.filter(F.split(rest, ","), lambda x: x != "")


def synthetic_id(language: Column, seed_id: Column) -> Column:
    """``syn-<language>-`` and the seed's id without its first ``seed-``."""
    return F.concat(F.lit("syn-"), language, F.lit("-"), F.regexp_replace(seed_id, r"(?s)^(.*?)seed-", "$1"))


def padded(n: Column, width: int) -> Column:
    """Zero-padded number that may grow wider."""
    return F.format_string(f"%0{width}d", n)


# The quotes and the opening words of a translation task.
def quoted_source(prompt: Column) -> Column:
    """The sentence between the first and last quote, or what follows ``Translate ...:``."""
    inside = strip_ws(F.regexp_extract(prompt, r"""(?s)['"](.+)['"]""", 1))
    rest = F.regexp_replace(strip_ws(F.regexp_replace(prompt, r"(?i)^\s*translate\b[^:]*:\s*", "")), r"""^['"]+|['"]+$""", "")
    return F.when(F.length(inside) > 0, inside).otherwise(rest)


def clamp01(c: Column) -> Column:
    """A score in 0..1; what is no number is 0, NaN is 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c.try_cast("double"), F.lit(0.0))))


def cosine(a: Column, b: Column) -> Column:
    """0 if either is zero; unequal lengths are an error."""
    add = lambda x, y: x + y
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), add)
    norm = lambda v: F.sqrt(F.aggregate(F.transform(v, lambda x: x.cast("double") * x), F.lit(0.0), add))
    checked = F.when(F.size(a) != F.size(b), F.raise_error("vectors of different length").cast("double"))
    return checked.otherwise(F.coalesce(F.try_divide(dot, norm(a) * norm(b)), F.lit(0.0)))


def percent(x: Column) -> Column:
    """``{x:.0%}``."""
    return F.concat(F.bround(100 * x, 0).cast("int").cast("string"), F.lit("%"))


def fixed(x: Column, digits: int) -> Column:
    """``{x:.nf}`` by half-even rounding of the decimal value."""
    return F.format_string(f"%.{digits}f", F.bround(x.cast("decimal(38,12)"), digits).cast("double"))


def median_or_zero(c: Column | str) -> Column:
    """Interpolated median, 0 of nothing."""
    return F.coalesce(F.median(c), F.lit(0.0))


def utc_day(ts: Column) -> Column:
    """The UTC date, whatever the session's time zone."""
    local = ts.cast("timestamp_ntz")  # wall time of the session's zone
    return F.date_format(F.convert_timezone(None, F.lit("UTC"), local), "yyyy-MM-dd")
