"""Specification queries: conversations are documents, their turns shots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.catalogue import register
from siftstone.operators import specs as S
from siftstone.plans.shared import table


def _specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per conversation, some of them damaged on purpose."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"))
    c = c.withColumn("k", F.col("conv_id") % 7)
    half = lambda i, side: F.concat(F.lit("這是"), F.lit(side), (F.col("conv_id") + i).cast("string"))
    shot = lambda i: F.struct(F.concat(F.lit("room "), i.cast("string")).alias("scene_qwen"), F.lit("a {room}").alias("scene_video"), F.lit("wall").alias("anchors"), F.lit("coat").alias("outfit"), F.array(half(i, "前"), half(i, "後")).alias("line"))
    structure = F.when(F.col("k") == 1, "4").when(F.col("k") == 2, "3").when(F.col("k") == 3, "9").otherwise("5")
    doc = F.struct(
        F.when(F.col("k") == 4, "a/b").otherwise(F.concat(F.lit("pkg"), F.col("conv_id").cast("string"))).alias("package"), F.lit("p").alias("shot_prefix"), structure.alias("structure"),
        F.when(F.col("k") == 5, "wave").otherwise("point").alias("cta"), F.when(F.col("k") == 6, F.lit(1)).alias("colour"),
        F.struct(F.lit("a").alias("qwen"), F.lit("b").alias("video")).alias("person"),
        F.struct(F.lit("cup").alias("word"), F.lit("red cup").alias("look_qwen"), F.lit("cup").alias("look_video"), F.when(F.col("conv_id") % 2 == 0, "10 cm").alias("size")).alias("product"),
        F.transform(F.sequence(F.lit(0), F.col("turns").cast("int") - 1), shot).alias("shots"),
    )
    return S.parse_specs(c.select("conv_id", F.to_json(doc).alias("raw")))


_SQL = "c AS (SELECT conv_id, count(*) AS turns, conv_id % 7 AS k FROM conversations GROUP BY 1), s AS (SELECT *, CASE k WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 9 ELSE 5 END AS st FROM c)"


def spec_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.violations(_specs(spark, sf_dir)).select("conv_id", F.array_join("errors", ",").alias("errors"))


register(
    "spec_violations", spec_violations,
    f"WITH {_SQL} SELECT conv_id, array_to_string(list_filter([CASE WHEN k = 6 THEN 'unknown:colour' END, CASE WHEN conv_id % 2 = 1 THEN 'required:product.size' END, CASE WHEN k = 4 THEN 'package' END, CASE WHEN st = 9 THEN 'structure' END, CASE WHEN k = 5 THEN 'cta' END, CASE WHEN st < 9 AND turns <> st THEN 'shots' END, CASE WHEN (st = 4 AND 6 * turns < 64) OR (st = 3 AND 6 * turns < 60) THEN 'package_length' END], lambda x: x IS NOT NULL), ',') AS errors FROM s",
)


def spec_shot_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.expand(_specs(spark, sf_dir), spark)
    return e.select("spec.package", "shot_id", "framing", "expression", "hand", "point", "smile", "t_talk", "length")


_PLAN = "plan(st, pos, framing, expression, hand, point, smile, t_talk, t_end, length) AS (VALUES " + ", ".join(f"({s}, {i}, '{p[0]}', '{p[1]}', {repr(p[2]) if p[2] else 'NULL'}, {p[3]}, {p[4]}, '{S.TIMING[s][0]}', '{S.TIMING[s][1]}', {S.TIMING[s][2]})" for s, plan in S.PLANS.items() for i, p in enumerate(plan)) + ")"
_SHOTS = f"{_SQL}, {_PLAN}, e AS (SELECT s.*, plan.* EXCLUDE (st), CASE WHEN k = 4 THEN 'a/b' ELSE concat('pkg', conv_id) END AS package, concat('p', pos + 1) AS shot_id FROM s JOIN plan USING (st) WHERE pos < turns)"
register("spec_shot_expand", spec_shot_expand, f"WITH {_SHOTS} SELECT package, shot_id, framing, expression, hand, point, smile, t_talk, length FROM e")


def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.render(S.expand(_specs(spark, sf_dir), spark)).select("package", "shot_id", "kind", "path", "text")


register(
    "prompt_render", prompt_render,
    f"""WITH {_SHOTS}, h AS (SELECT *, concat('這是前', conv_id + pos) AS a, concat('這是後', conv_id + pos) AS b, CASE WHEN hand IS NULL THEN 'out of the picture.' ELSE concat('holds the red cup in the ', hand, ' hand, an easy grip, size ', CASE WHEN conv_id % 2 = 0 THEN '10 cm' ELSE '' END, '.', CASE WHEN point AND k <> 5 THEN concat(' The ', CASE hand WHEN 'left' THEN 'right' ELSE 'left' END, ' hand points down.') ELSE '' END) END AS hands FROM e)
 SELECT package, shot_id, 'image' AS kind, concat('_qwen指令/q_', shot_id, '.txt') AS path, concat('Place: room ', pos, ' Camera: ', framing, ' Clothes: coat. Hair: neat. Hands: ', hands, ' Expression: ', expression, '.') AS text FROM h
 UNION ALL SELECT package, shot_id, 'video', concat('prompt_', shot_id, 'D.txt'), concat('a {{room}}; coat. ', hands, ' Camera ', framing, ', edges on wall.', chr(10), '[0.0s-', t_talk, 's] ', a, '，', b, ' [', t_talk, 's-', t_end, 's] ', CASE WHEN smile THEN 'a soft smile.' ELSE 'a calm face.' END, chr(10)) FROM h
 UNION ALL SELECT package, shot_id, 'voiceover', concat('口白腳本_', shot_id, 'D.txt'), concat(a, chr(10), b, chr(10)) FROM h""",
)


# A valid document of three shots, and by number what is put in place of what, with the errors that must come of it.
_SHOT = '{"scene_qwen":"a","scene_video":"b","anchors":"c","outfit":"d","line":["這是很好的早晨陽光灑","今天要出門散步看海浪"]}'
VALID = '{"package":"p","shot_prefix":"s1","structure":"3","person":{"qwen":"a","video":"b"},"product":{"word":"w","look_qwen":"q","look_video":"v","size":"s"},"shots":[' + ",".join([_SHOT] * 3) + "]}"
DEFECTS = (
    ("", "", ""), ('"package":"p"', '"package":"a/b"', "package"), ('"package":"p"', '"package":5', "type:package"), ('"shot_prefix":"s1"', '"shot_prefix":"s_1"', "shot_prefix"),
    ('"structure":"3"', '"structure":3', "type:structure"), ('"structure":"3"', '"structure":"6"', "structure"), ('"structure":"3"', '"structure":"3","cta":"wave"', "cta"),
    ('"structure":"3"', '"structure":"3","note":7', "type:note"), ('"structure":"3"', '"structure":"3","note":" "', "blank:note"), ('"qwen":"a","video"', '"qwen":" ","video"', "blank:person.qwen"),
    ('"size":"s"', '"grip":"g"', "required:product.size"), ('"size":"s"', '"size":"s","grip":""', "blank:product.grip"), ('"person":{', '"colour":1,"person":{', "unknown:colour"),
    ('"person":{', '"person":{"age":3,', "unknown:person.age"), ('"person":{"qwen":"a","video":"b"}', '"person":"x"', "type:person"), ('"outfit":"d"', '"outfit":"d","mood":1', "unknown:shots[0].mood,unknown:shots[1].mood,unknown:shots[2].mood"),
    ('"outfit":"d",', "", "required:shots[0].outfit,required:shots[1].outfit,required:shots[2].outfit"), ('"anchors":"c"', '"anchors":3', "type:shots[0].anchors,type:shots[1].anchors,type:shots[2].anchors"),
    ('"anchors":"c"', '"anchors":""', "blank:shots[0].anchors,blank:shots[1].anchors,blank:shots[2].anchors"), ('"這是很好的早晨陽光灑",', "", "line,package_length"), ('"這是很好的早晨陽光灑"', '"這是很好的早晨陽光灑 "', "half"),
    ('"這是很好的早晨陽光灑"', '"這是很好的連結陽光灑"', "banned"), ('"這是很好的早晨陽光灑"', '"這是很好的早晨陽光灑在這裡"', "shot_length"), ('"這是很好的早晨陽光灑"', '"這是"', "package_length"), (VALID[-len(_SHOT) - 3 :], "]}", "shots,package_length"),
)


def spec_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document for each nation, each with the defect of its key."""
    k = F.col("n_nationkey") % len(DEFECTS)
    documents = F.array(*[F.lit(VALID.replace(old, new) if old else VALID) for old, new, _ in DEFECTS])
    raw = table(spark, sf_dir, "nation").select("n_nationkey", F.get(documents, k).alias("raw"))
    return S.violations(S.parse_specs(raw)).select("n_nationkey", F.array_join("errors", ",").alias("errors"))


register("spec_defects", spec_defects, "WITH e(k, errors) AS (VALUES " + ", ".join(f"({k}, '{e}')" for k, (_, _, e) in enumerate(DEFECTS)) + f") SELECT n_nationkey, errors FROM nation JOIN e ON k = n_nationkey % {len(DEFECTS)}")
