"""Routers: one pass that tags each row with its output, and the split by tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Endings and their types (fixed values).
MIME = {
    "txt": "text/plain", "html": "text/html", "htm": "text/html", "md": "text/markdown", "markdown": "text/markdown", "csv": "text/csv",
    "json": "application/json", "pdf": "application/pdf", "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "msg": "application/vnd.ms-outlook",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation", "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}


def by_length(content: Column, threshold: int) -> Column:
    return F.when(content.isNull() | (F.length(content) <= threshold), "short_documents").otherwise("long_documents")


def by_language(language: Column, languages: list[str]) -> Column:
    return F.when(language.isin(languages), language).otherwise("unmatched")


#: Frequent short words by language (fixed values).
MARKER_WORDS = {
    "en": "the of and to in is that it was for with as".split(), "de": "der die und das nicht ist ein zu den mit sich von".split(),
    "fr": "le la les et des est une dans que pour qui du".split(), "es": "el los y del las por con una para como más su".split(),
}


def language_of(text: Column, unknown: str | None = None) -> Column:
    """Language whose marker words the text holds most often, in the order of ``MARKER_WORDS`` at ties; ``unknown`` without any."""
    tokens = F.split(F.lower(text), "[^\\p{L}]+")

    def held(words: list[str]) -> Column:
        return F.size(F.filter(tokens, lambda t: t.isin(words)))

    counts = F.array(*[F.struct(held(words).alias("n"), F.lit(-i).alias("at"), F.lit(name).alias("name")) for i, (name, words) in enumerate(MARKER_WORDS.items())])
    best = F.array_max(counts)
    return F.when(best["n"] > 0, best["name"]).otherwise(F.lit(unknown))


def by_threshold(value: Column, threshold) -> Column:
    return F.when(value < threshold, "below").otherwise("above")


def by_parity(value: Column) -> Column:
    return F.when(F.pmod(value, F.lit(2)) == 0, "even").otherwise("odd")


def by_remainder(value: Column, divisor: int) -> Column:
    if divisor == 0:
        raise ValueError("divisor is 0")
    return F.concat(F.lit("remainder_is_"), F.pmod(value, F.lit(divisor)))


def by_conditions(routes: list[tuple[Column, str]], default: str | None = None) -> Column:
    """The first route whose condition holds."""
    out = F.lit(None).cast("string") if default is None else F.lit(default)
    for condition, name in reversed(routes):
        out = F.when(condition, name).otherwise(out)
    return out


def mime_of_path(path: Column) -> Column:
    ending = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)(?:[?#].*)?$", 1))
    pairs = [F.lit(x) for pair in MIME.items() for x in pair]
    return F.element_at(F.create_map(*pairs), ending)


def mime_of_bytes(content: Column) -> Column:
    """Type by the first bytes, in order of the list (fixed values)."""
    head = F.hex(F.substring(content, 1, 12))
    signatures = [
        ("image/png", "^89504E470D0A1A0A"), ("image/jpeg", "^FFD8FF"), ("image/gif", "^47494638"), ("image/webp", "^52494646.{8}57454250"), ("image/bmp", "^424D"), ("application/pdf", "^25504446"),
        ("application/zip", "^504B0304"), ("application/gzip", "^1F8B08"), ("application/x-bzip2", "^425A68"), ("application/x-xz", "^FD377A585A00"), ("application/zstd", "^28B52FFD"), ("audio/mpeg", "^494433"),
        ("audio/x-wav", "^52494646.{8}57415645"), ("application/ogg", "^4F676753"), ("video/mp4", "^.{8}66747970"), ("font/woff", "^774F4646"), ("font/woff2", "^774F4632"),
    ]
    return by_conditions([(head.rlike(p), m) for m, p in signatures])


def split(df: DataFrame, tag: Column, names: list[str]) -> dict[str, DataFrame]:
    """One lazy branch for each name; all read the same plan."""
    tagged = df.withColumn("_route", tag)
    return {n: tagged.where(F.col("_route") == n).drop("_route") for n in names}


def by_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row for every rule that a row meets, tagged ``route``; ``unmatched`` where none does."""
    hits = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    return df.withColumn("route", F.explode(F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit("unmatched")))))
