"""Narration lint: regular-expression rules per line, counts over a package."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftstone.functions import texts

# The rules' patterns, hard ones first.
HARD = {
    "digits": r"[0-9０-９]",
    "particle": r"欸",
    "absolute": r"(最好|最棒|最強|一定|絕對|絕不|永遠|百分百|保證|第一名|完全不)",
    "price": r"(元|塊錢|折|免運|優惠|特價|便宜)",
    "claim": r"(美白|抗老|淡斑|除皺|去痘|消炎|治療|療效|瘦身|減肥|豐胸|生髮)",
    "platform": r"(FB|IG|LINE|Instagram|Facebook|抖音|TikTok)",
    "misread": r"(連結|漬|每次|髮質|一整|整個|整天|整箱|整包|舒跑)",
}
WARN = {
    "tones": r"(髮尾)",
    "latin": r"[A-Za-z]{2,}",
    "mood": r"(可惜|不想|好煩|討厭|受不了|崩潰|氣死|超煩)",
    "risky": r"(乾|囤|凍|罐|訂|殼|倒|防曬|整|重|痠|結)",
    "quantity": r"[二三四五六七八九十百千]+(支|包|入|片|瓶|罐|克|天|次|小時|分鐘|公斤|毫升|種|組|條|顆|粒)",
}
STOP_GRAM = r"(的|了|是|在|我|你|他|就|都|也|很|有|跟|和|把|會|能|可以|這|那|一)"
SHORTEST, LONGEST, SECONDS_A_SHOT, LEAST_SECONDS = 3, 13, 3.6, 15


def lines_of(files: DataFrame, text: str = "text") -> DataFrame:
    """(file, line_no, line) of the non-blank lines, stripped, numbered from 0."""
    at = files.select("file", F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("line_no", "line"))
    return at.withColumn("line", F.regexp_replace("line", r"^\s+|\s+$", "")).filter("line != ''")


def issues(lines: DataFrame, hard: dict[str, str] = HARD, warn: dict[str, str] = WARN) -> DataFrame:
    """A row per line and rule that it breaks: rule, hard, and what was found (distinct, joined)."""
    found = lambda name, is_hard, pattern: F.struct(F.lit(name).alias("rule"), F.lit(is_hard).alias("hard"), F.array_join(texts.distinct_hits(F.col("line"), pattern), "」「").alias("found"))
    rules = [found(n, True, p) for n, p in hard.items()] + [found(n, False, p) for n, p in warn.items()]
    n = F.length(texts.bare(F.col("line")))
    size = F.when(n < SHORTEST, "short").when(n > LONGEST, "long")
    rules.append(F.struct(F.lit("length").alias("rule"), F.lit(False).alias("hard"), F.coalesce(size, F.lit("")).alias("found")))
    return lines.select("file", "line_no", F.explode(F.array(*rules)).alias("r")).select("file", "line_no", "r.*").filter("found != ''")


def several_files(files: DataFrame, package: str = "package") -> DataFrame:
    """The packages that have more than one file; what is counted over a package is counted for these only."""
    return files.groupBy(package).agg(F.count("*").alias("files")).filter("files > 1").select(package)


def repeated_grams(lines: DataFrame, files: DataFrame, least: int = 3, package: str = "package") -> DataFrame:
    """(package, gram, n): bigrams that a package of several files has `least` times or more, without those that hold a stop word.

    lines: package and line; files: a row with the package for each file.
    """
    grams = lines.join(several_files(files, package), package, "left_semi").select(package, F.explode(texts.bigrams(F.col("line"))).alias("gram"))
    return grams.filter(~F.col("gram").rlike(STOP_GRAM)).groupBy(package, "gram").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def same_endings(lines: DataFrame, package: str, order: list[str]) -> DataFrame:
    """Lines that end with the character that the line before ends with."""
    end = F.substring(texts.bare(F.col("line")), -1, 1)
    w = Window.partitionBy(package).orderBy(*order)
    return lines.withColumn("ending", end).withColumn("before", F.lag("ending").over(w)).filter("ending != '' AND ending = before").drop("before")


def summary(files: DataFrame, broken: DataFrame) -> DataFrame:
    """Per package: files, hard issues (a missing file is one), estimated seconds and whether they are too few."""
    n = files.groupBy("package").agg(F.count("*").alias("files"), F.count_if(F.col("text").isNull()).alias("missing"))
    hard = broken.filter("hard").join(files.select("file", "package"), "file").groupBy("package").agg(F.count("*").alias("hard"))
    s = n.join(hard, "package", "left").withColumn("hard", F.coalesce("hard", F.lit(0)) + F.col("missing"))
    seconds = F.col("files") * SECONDS_A_SHOT
    return s.select("package", "files", "hard", seconds.alias("seconds"), (seconds < LEAST_SECONDS).alias("too_short"))
