"""Token operators: vocabulary lookup, norms, rules, spans over tokens, bags of words, CSV tables in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.text import PUNCTUATION, words

#: Forms and their norms (fixed values).
NORMS = {
    "'s": "'s", "'S": "'s", "’s": "'s", "’S": "'s", "’": "'", "‘": "'", "´": "'", "`": "'",
    "”": '"', "“": '"', "''": '"', "``": '"', "´´": '"', "„": '"', "»": '"', "«": '"', "‘‘": '"', "’’": '"',
    "？": "?", "！": "!", "，": ",", "；": ";", "：": ":", "。": ".", "।": ".", "…": "...",
    "—": "-", "–": "-", "--": "-", "---": "-", "——": "-",
    "€": "$", "£": "$", "¥": "$", "฿": "$", "US$": "$", "C$": "$", "A$": "$", "₺": "$", "₹": "$", "৳": "$", "₩": "$", "Mex$": "$", "₣": "$", "E£": "$",
}


def strip_punctuation(token: Column) -> Column:
    return F.rtrim(F.ltrim(token, F.lit(PUNCTUATION)), F.lit(PUNCTUATION))


def vocabulary_ids(df: DataFrame, key: str, text: str, vocabulary: DataFrame, stop: list[str]) -> DataFrame:
    """(key, pos, id): each token as it is, else without punctuation, else in lower case, whichever the vocabulary (token, id) has first; stop words and unknown ones go."""
    tokens = df.select(key, F.posexplode(words(F.col(text))).alias("pos", "t0"))
    tokens = tokens.withColumn("t1", strip_punctuation(F.col("t0"))).withColumn("t2", F.lower("t1"))
    forms = tokens.select(key, "pos", F.posexplode(F.array("t0", "t1", "t2")).alias("stage", "token")).where(~F.col("token").isin(stop) & (F.col("token") != ""))
    hit = forms.join(vocabulary, "token")
    return hit.groupBy(key, "pos").agg(F.min_by("id", "stage").alias("id"))


def norm(token: Column) -> Column:
    pairs = [F.lit(x) for kv in NORMS.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), token), F.lower(token))


def lemmas(df: DataFrame, token: str, rules: list[tuple[str, str]], exceptions: dict[str, str], known: DataFrame) -> DataFrame:
    """``lemma``: the exception, else the first suffix rule that makes a known form (column ``form``), else the token."""
    pairs = [F.lit(x) for kv in exceptions.items() for x in kv]
    tries = F.array(*[F.when(F.col(token).endswith(a), F.concat(F.expr(f"left({token}, length({token}) - {len(a)})"), F.lit(b))) for a, b in rules])
    each = df.select(token).distinct().select(token, F.posexplode(tries).alias("rule", "form")).where("form IS NOT NULL")
    best = each.join(known.select("form").distinct(), "form", "left_semi").groupBy(token).agg(F.min_by("form", "rule").alias("_f"))
    given = F.element_at(F.create_map(*pairs), F.col(token)) if pairs else F.lit(None).cast("string")
    return df.join(best, token, "left").withColumn("lemma", F.coalesce(given, "_f", token)).drop("_f")


def phrase_spans(df: DataFrame, key: str, tokens: str, patterns: DataFrame, longest: int = 5) -> DataFrame:
    """(key, start, end, label): longest matches of phrases (phrase, label) of lower-cased tokens; of overlapping ones the longer, then the earlier, stays."""
    low = F.transform(tokens, F.lower)
    spans = []
    for n in range(1, longest + 1):
        grams = df.select(key, F.when(F.size(low) >= n, low).alias("_w")).where("_w IS NOT NULL")
        spans.append(grams.select(key, F.posexplode(F.transform(F.sequence(F.lit(1), F.size("_w") - n + 1), _gram(n))).alias("start", "phrase"), F.lit(n).alias("n")))
    found = spans[0]
    for s in spans[1:]:
        found = found.unionByName(s)
    found = found.join(patterns, "phrase").select(key, "start", (F.col("start") + F.col("n")).alias("end"), "label", "n")
    found = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "start", "end", "label"))).alias("_s"))
    free = lambda out, x: ~F.exists(out, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
    kind = "array<struct<m:int,start:int,end:int,label:string>>"
    kept = F.aggregate(F.col("_s").cast(kind), F.array().cast(kind), lambda out, x: F.when(free(out, x), F.concat(out, F.array(x))).otherwise(out))
    return found.select(key, F.explode(kept).alias("x")).select(key, "x.start", "x.end", "x.label")


def _gram(n: int):
    return lambda i: F.array_join(F.slice("_w", i, n), " ")


def merge_runs(df: DataFrame, key: str, pos: str, token: str, label: str) -> DataFrame:
    """One row for each run of equal labels: (key, start, merged, label); tokens without a label stay alone."""
    w = Window.partitionBy(key).orderBy(pos)
    fresh = F.when(F.col(label).isNull() | ~F.col(label).eqNullSafe(F.lag(label).over(w)), 1).otherwise(0)
    runs = df.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy(key, "_run").agg(F.min(pos).alias("start"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(pos, token))), lambda x: x[token]), " ").alias("merged"), F.first(label).alias("label")).drop("_run")


def join_phrases(text: Column, phrases: list[str], mark: str = "_") -> Column:
    """Tokens of a text with each of the ``phrases`` (words with single blanks, any case) as one token joined by ``mark``; longer phrases first."""
    joined = F.concat(F.lit(" "), F.array_join(words(text), " "), F.lit(" "))
    for phrase in sorted(phrases, key=lambda p: (-p.count(" "), p)):
        pattern = r"(?i)(?<= )" + " ".join(f"\\Q{w}\\E" for w in phrase.split(" ")) + "(?= )"
        joined = F.regexp_replace(joined, pattern, phrase.lower().replace(" ", mark))
    return words(joined)


def bag_of_words(df: DataFrame, key: str, text: str, weights: DataFrame, unknown: float, cumulative: bool = True) -> DataFrame:
    """(key, token, value): weight of each token as it is, else in lower case, else ``unknown``; summed, or once with ``cumulative`` off."""
    tokens = df.select(key, F.explode(words(F.col(text))).alias("token"))
    exact, low = weights.select("token", F.col("weight").alias("_a")), weights.select(F.col("token").alias("_l"), F.col("weight").alias("_b"))
    weighed = tokens.join(exact, "token", "left").join(low, F.lower("token") == F.col("_l"), "left").select(key, F.when(F.col("_a").isNotNull(), F.col("token")).otherwise(F.coalesce("_l", F.lit("<unknown>"))).alias("token"), F.coalesce("_a", "_b", F.lit(unknown)).alias("w"))
    return weighed.groupBy(key, "token").agg((F.sum("w") if cumulative else F.max("w")).alias("value"))


def csv_cells(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, row, col, cell) of CSV text without quoted line breaks."""
    rows = df.select(key, F.posexplode(F.split(F.regexp_replace(text, "\\r?\\n$", ""), "\\r?\\n")).alias("row", "line"))
    return rows.select(key, "row", F.posexplode(F.split("line", ",(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)")).alias("col", "cell"))


def clean_csv(df: DataFrame, key: str, text: str) -> DataFrame:
    """``content``: the CSV text without rows and columns that are empty."""
    cells = csv_cells(df, key, text).withColumn("full", (F.trim("cell") != "").cast("int"))
    cells = cells.withColumn("_r", F.max("full").over(Window.partitionBy(key, "row"))).withColumn("_c", F.max("full").over(Window.partitionBy(key, "col"))).where("_r = 1 AND _c = 1")
    lines = cells.groupBy(key, "row").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("col", "cell"))), lambda x: x["cell"]), ",").alias("line"))
    return lines.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row", "line"))), lambda x: x["line"]), "\n").alias("content"))


def split_csv(df: DataFrame, key: str, text: str, empty_rows: int = 2) -> DataFrame:
    """(key, part, first_row, n_rows): tables of a CSV text that ``empty_rows`` empty rows set apart."""
    rows = df.select(key, F.posexplode(F.split(F.regexp_replace(text, "\\r?\\n$", ""), "\\r?\\n")).alias("row", "line")).withColumn("full", F.col("line").rlike("[^,\\s\"]"))
    w = Window.partitionBy(key).orderBy("row")
    full = rows.where("full").withColumn("_new", F.when(F.col("row") - F.lag("row").over(w) > empty_rows, 1).otherwise(0)).withColumn("part", F.sum("_new").over(w))
    return full.groupBy(key, "part").agg(F.min("row").alias("first_row"), (F.max("row") - F.min("row") + 1).alias("n_rows"))
