"""Image verdicts from measures: reasons by rule, severity, a judge that can only tighten, paging."""

from __future__ import annotations

import base64
import json
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

REJECT, HUMAN, ACCEPT, NOTE = "不收", "要人眼", "收", "備註"

# The thresholds of the screening rules.
LEAST_FG, UNIFORM, MARK_GAP, LONG_MIN, LONG_OK, HEIGHT_MIN, WIDE = 400, 0.60, 4, 700, 1000, 600, 1.6
SOLID_MIN, SOLID_OK, WHITE, MARKS, SIDES, SLANT, SYMMETRY, REPEAT, RECT = 0.75, 0.88, 0.50, 6, 3, 8.0, 0.92, 0.75, 0.90


def rules(m: Column) -> Column:
    """array<struct<level,code>> for a struct of measures (readable, uniform, foreground, mark_gap, crosses_text, bar, long_side, height, width, objects, solidity, white, faint_marks, mark_sides, faint_gap, slant, second_face, symmetry, repeat, at_edge); null measures break no rule."""
    c = lambda name: m[name]
    wide = c("width") / F.greatest(c("height"), F.lit(1)) >= WIDE
    seen = c("readable") & (c("foreground") >= LEAST_FG)
    cases = [
        (~c("readable"), REJECT, "read"),
        (c("readable") & (c("uniform") < UNIFORM), HUMAN, "bg"),
        (c("readable") & (c("foreground") < LEAST_FG), HUMAN, "nofg"),
        (seen & (c("mark_gap") < MARK_GAP), HUMAN, "near-mark"),
        (seen & c("crosses_text"), HUMAN, "cross-text"),
        (seen & ~c("crosses_text") & (c("bar") >= 0.02), HUMAN, "cross-bar"),
        (seen & ~c("crosses_text") & (c("bar") < 0.02), HUMAN, "cross-bar?"),
        (seen & (c("long_side") < LONG_MIN), REJECT, "long<700"),
        (seen & (c("long_side") >= LONG_MIN) & (c("long_side") < LONG_OK), HUMAN, "long700-999"),
        (seen & (c("height") < HEIGHT_MIN) & ~wide, REJECT, "h<600"),
        (seen & (c("height") < HEIGHT_MIN) & wide, HUMAN, "wide"),
        (seen & (c("objects") != 1), REJECT, "n_obj"),
        (seen & (c("solidity") < SOLID_MIN), REJECT, "solid<.75"),
        (seen & (c("solidity") >= SOLID_MIN) & (c("solidity") < SOLID_OK), HUMAN, "solid.75-.88"),
        (seen & (c("white") >= WHITE), HUMAN, "white"),
        (seen & (c("faint_marks") >= MARKS) & (c("mark_sides") >= SIDES), HUMAN, "wm"),
        (seen & (c("faint_marks") >= MARKS) & (c("mark_sides") < SIDES) & (c("faint_gap") < MARK_GAP), HUMAN, "wm-near"),
        (seen & (c("slant") > SLANT) & c("second_face") & (c("symmetry") < SYMMETRY), REJECT, "slant"),
        (seen & (c("repeat") >= REPEAT), HUMAN, "repeat"),
        (seen & c("at_edge"), NOTE, "edge"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"))) for cond, level, code in cases]))


def severity(level: Column) -> Column:
    return F.when(level == REJECT, 2).when(level == HUMAN, 1).otherwise(0)


def verdict(reasons: Column) -> Column:
    """The most severe level; notes don't count."""
    most = F.coalesce(F.array_max(F.transform(reasons, lambda r: severity(r["level"]))), F.lit(0))
    return F.when(most == 2, REJECT).when(most == 1, HUMAN).otherwise(ACCEPT)


#: The questions that a judge is asked, and the answers that count against a photo.
BAD = {"single_product": "false", "front_view": "false", "added_text": "true", "multi_pack": "true"}


def delegated(m: Column) -> Column:
    """array of the questions that the measures leave open: added_text (text or a bar inside of the product), front_view (not clearly frontal)."""
    c = lambda name: m[name]
    seen = c("readable") & (c("foreground") >= LEAST_FG)
    tilted = c("slant") > SLANT
    clear = ((~tilted & (c("rect") >= RECT)) | (c("symmetry") >= SYMMETRY)) & ~c("second_face")
    rejected = tilted & c("second_face") & (c("symmetry") < SYMMETRY)
    cases = [(c("inner_text") > 0, "added_text"), (~clear & ~rejected, "front_view"), (c("inner_bar").isNotNull(), "added_text")]
    return F.array_distinct(F.array_compact(F.array(*[F.when(F.coalesce(seen & cond, F.lit(False)), F.lit(q)) for cond, q in cases])))


def suggestions(m: Column) -> Column:
    """array of texts: boxes that may be painted in the background's colour, and what to do about white products."""
    seen = m["readable"] & (m["foreground"] >= LEAST_FG)
    one = lambda b: F.format_string("paint x %d-%d, y %d-%d (%s, %d px off the product)", b["x0"], b["x1"], b["y0"], b["y1"], b["kind"], b["gap"])
    texts = F.coalesce(F.transform(m["paint"], one), F.array().cast("array<string>"))
    white = F.when(m["white"] >= WHITE, F.array(F.lit("white product: cut it out first and screen it with its alpha channel"))).otherwise(F.array().cast("array<string>"))
    return F.when(seen, F.concat(texts, white)).otherwise(F.array().cast("array<string>"))


def judged(reasons: Column, answers: Column, bad: dict[str, str], open_questions: Column | None = None) -> Column:
    """reasons, tightened by a judge's answers (map question -> 'true'/'false'; null: none came).

    Open questions always go to a human, whatever the answer; bad answers add
    a reason, but a judge isn't asked after a reject.  Nothing is taken away.
    """
    added = F.array_compact(F.array(*[F.when(F.coalesce(F.element_at(answers, F.lit(q)) == a, F.lit(False)), F.struct(F.lit(HUMAN).alias("level"), F.lit(f"model:{q}").alias("code"))) for q, a in bad.items()]))
    if open_questions is not None:
        left = F.transform(open_questions, lambda q: F.struct(F.lit(HUMAN).alias("level"), F.concat(F.lit("judge:"), q).alias("code")))
        return F.concat(reasons, left, F.when(verdict(reasons) == REJECT, F.slice(added, 1, 0)).otherwise(added))
    return F.when(verdict(reasons) == REJECT, reasons).otherwise(F.concat(reasons, added))


class Judge:
    """Answers questions on one photo: ask(row, questions) gives {"status": "ok", "answers": {question: bool}} or another status."""

    def ask(self, row: Row, questions: list[str]) -> dict:
        raise NotImplementedError


class NullJudge(Judge):
    """No judge is connected."""

    def ask(self, row, questions):
        return {"status": "not_connected"}


class HttpJudge(Judge):
    """A chat service that takes images; row has content (an encoded image) and kind (its MIME type)."""

    def __init__(self, url: str, model: str, timeout: float = 120.0):
        self.url, self.model, self.timeout = url, model, timeout

    def body(self, row, questions) -> dict:
        text = "Judge by the picture alone. Answer with a JSON object that has true or false for: " + ", ".join(questions)
        picture = f"data:{row.kind};base64,{base64.b64encode(row.content).decode('ascii')}"
        return {"model": self.model, "temperature": 0, "messages": [{"role": "user", "content": [{"type": "text", "text": text}, {"type": "image_url", "image_url": {"url": picture}}]}]}

    def ask(self, row, questions):
        call = urllib.request.Request(self.url, json.dumps(self.body(row, questions)).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(call, timeout=self.timeout) as reply:
            said = json.load(reply)["choices"][0]["message"]["content"]
        found = json.loads(said[said.index("{") : said.rindex("}") + 1])
        return {"status": "ok", "answers": {q: found[q] for q in questions if isinstance(found.get(q), bool)}}


def screened_by(results: DataFrame, judge: Judge, bad: dict[str, str] = BAD) -> DataFrame:
    """results (reasons, open, and what the judge reads) with status, after (the reasons, tightened) and verdict.

    Rejected photos don't reach the judge.  A judge that fails on a row gives
    an error status there, and counts as none.
    """
    kind, columns = "status string, answers map<string,string>", results.columns

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            said = []
            for row in b.itertuples(index=False):
                try:
                    said.append(judge.ask(row, list(bad)))
                except Exception as e:  # a lost judge must not stop the screening
                    said.append({"status": f"error: {type(e).__name__}: {e}"})
            b["status"] = [a["status"] for a in said]
            b["answers"] = [{q: str(v).lower() for q, v in a.get("answers", {}).items()} for a in said]
            yield b[[*columns, "status", "answers"]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in results.schema)
    asked = results.filter(verdict(F.col("reasons")) != REJECT).mapInPandas(work, f"{schema}, {kind}")
    skipped = results.filter(verdict(F.col("reasons")) == REJECT).select("*", F.lit("skipped").alias("status"), F.lit(None).cast("map<string,string>").alias("answers"))
    out = asked.unionByName(skipped).withColumn("after", judged(F.col("reasons"), F.col("answers"), bad, F.col("open")))
    return out.drop("answers").withColumn("verdict", verdict(F.col("after")))


def ordered(results: DataFrame, row_index) -> DataFrame:
    """results with rank: by verdict, the longer side first (missing is 0), then the path."""
    level = F.when(F.col("verdict") == ACCEPT, 0).when(F.col("verdict") == HUMAN, 1).otherwise(2)
    return row_index(results, [level.asc(), F.coalesce("long_side", F.lit(0)).desc(), F.col("path").asc()], "rank")


def page(rank: Column, size: int = 100) -> Column:
    return F.floor((rank - 1) / size) + 1


def report(results: DataFrame) -> DataFrame:
    """The rows of a screening report, as texts: results (rank, path, verdict, reasons, hints, and measures), by rank; what is missing is a dash."""
    c, dash = F.col, F.lit("—")
    text = lambda v: F.coalesce(v.cast("string"), dash)
    why = F.array_join(F.transform("reasons", lambda r: F.concat(F.lit("【"), r["level"], F.lit("】"), r["code"])), "；")
    some = lambda v: F.when(F.coalesce(v, F.lit("")) == "", dash).otherwise(v)
    cells = {
        "#": c("rank").cast("string"), "file": F.element_at(F.split("path", "/"), -1), "verdict": c("verdict"), "product": F.coalesce(F.concat(c("width").cast("string"), F.lit("×"), c("height").cast("string")), dash),
        "long side": text(c("long_side")), "solidity": F.when(c("solidity").isNull(), dash).otherwise(F.format_string("%.3f", c("solidity"))), "objects": text(c("objects")), "reasons": some(why), "suggestions": some(F.array_join("hints", "；")),
    }
    return results.orderBy("rank").select(*[v.alias(k) for k, v in cells.items()])


def result_json(results: DataFrame, measures: list[str], name: str = "path") -> DataFrame:
    """(name, json): one document per photo of results (verdict, reasons, measures): file, verdict, reasons and measure; null measures are left out."""
    document = F.struct(F.col(name).cast("string").alias("file"), "verdict", "reasons", F.struct(*measures).alias("measure"))
    return results.select(name, F.to_json(document).alias("json"))
