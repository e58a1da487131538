"""Scalar functions as Columns: white space, paths, identifiers, validator lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How validator output is read.
LINE = r"^.+?:(?:\d+:\d+: )?(error|fatal): (.+)$"
SUBJECT = r'(?:element|attribute) "([^"]+)"'
TAIL = r"(?s);? expected.*$"
SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0  -     　]"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"{SPACE}+", " "))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def without_hashes(c: Column) -> Column:
    """All leading # go."""
    return F.regexp_replace(c, "^#+", "")


def without_hash(c: Column) -> Column:
    """One leading # goes."""
    return F.regexp_replace(c, "^#", "")


def after_hash(c: Column) -> Column:
    """What follows the first #, or nothing."""
    return F.when(F.locate("#", c) > 0, F.substr(c, F.locate("#", c) + 1)).otherwise("")


def truthy(c: Column) -> Column:
    return or_empty(F.lower(strip(c))).isin("true", "1", "yes")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The file name without its last suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def computed_urn(path: Column) -> Column:
    """urn:cts:{namespace}:{stem} from the first canonical-{namespace}/data/ in the path, or nothing."""
    ns = F.regexp_extract(path, "canonical[-_]([^/]+)/data/", 1)
    return F.when((ns != "") & (stem(path) != ""), F.concat(F.lit("urn:cts:"), ns, F.lit(":"), stem(path))).otherwise("")


def existing_urn(base: Column) -> Column:
    return F.when(base.startswith("urn:cts:"), base).otherwise("")


def map_urn(path: Column, base: Column) -> Column:
    """For the genre map: the document's own URN, then the computed one, then the stem."""
    return F.coalesce(or_null(existing_urn(base)), or_null(computed_urn(path)), stem(path))


def pipeline_urn(path: Column, base: Column, override: Column | None = None) -> Column:
    """For rewriting: an explicit URN, then the computed one, then the document's own."""
    given = or_null(override) if override is not None else F.lit(None).cast("string")
    return or_empty(F.coalesce(given, or_null(computed_urn(path)), or_null(existing_urn(base))))


def camel_case(c: Column) -> Column:
    words = F.split(collapse(c), " ")
    rest = F.transform(F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))))
    return F.concat(F.lower(F.element_at(words, 1)), F.array_join(rest, ""))


#: Informal language codes and what they stand for.
LANGUAGES = {"greek": "grc", "la": "lat", "fr": "fra", "en": "eng"}


def language(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])
    return F.coalesce(known[c], c)


def boolean(c: Column) -> Column:
    return F.when(c == "yes", "true").when(c == "no", "false").otherwise(c)


def validator_line(line: Column) -> Column:
    """struct<stem, subject, message> of a line, or null if it isn't one of an error."""
    text = F.regexp_extract(line, LINE, 2)
    parsed = F.struct(
        stem(F.substring_index(line, ":", 1)).alias("stem"),
        F.regexp_extract(text, SUBJECT, 1).alias("subject"),
        strip(F.regexp_replace(text, TAIL, "")).alias("message"),
    )
    return F.when(text != "", parsed)
