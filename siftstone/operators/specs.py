"""Specification documents: validation as data, shot expansion and rendering of texts by templates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.functions import texts

SCHEMA = (
    "package string, shot_prefix string, structure string, cta string, shot1_hair_qwen string, note string, "
    "person struct<qwen:string,video:string,id:string,note:string>, product struct<word:string,look_qwen:string,look_video:string,size:string,grip:string,note:string>, "
    "shots array<struct<scene_qwen:string,scene_video:string,anchors:string,outfit:string,line:array<string>,note:string>>"
)
# The fields of a document, ! for those it must have, with their types.
FIELDS = {
    "": {"package": "!text", "shot_prefix": "!text", "person": "!object", "product": "!object", "shots": "!list", "shot1_hair_qwen": "text", "note": "text", "structure": "text", "cta": "text"},
    "person": {"qwen": "!text", "video": "!text", "id": "text", "note": "text"},
    "product": {"word": "!text", "look_qwen": "!text", "look_video": "!text", "size": "!text", "grip": "text", "note": "text"},
    "shots": {"scene_qwen": "!text", "scene_video": "!text", "anchors": "!text", "outfit": "!text", "line": "!list", "note": "text"},
}
KINDS = {"text": "^STRING", "object": "^OBJECT", "list": "^ARRAY"}

# The shots of each structure (framing, expression, hand with the product, pointing, smile at the end),
# its timing, and the limits of characters per shot and least per package.
PLANS = {
    "5": [("F1", "uneasy", None, False, False), ("F2", "pleased", "right", False, True), ("F3", "pleased", "left", False, True), ("F4", "bright", "right", False, True), ("F5", "warm", "left", True, True)],
    "4": [("F1", "uneasy", None, False, False), ("F2", "pleased", "right", False, True), ("F3", "bright", "left", False, True), ("F4", "warm", "right", True, True)],
    "3": [("F1", "uneasy", None, False, False), ("F3", "pleased", "right", False, True), ("F4", "warm", "left", True, True)],
}
TIMING = {"5": ("4.0", "5.1", 124), "4": ("4.2", "5.1", 124), "3": ("5.6", "6.5", 156)}
CHARS = {"4": (18, 64), "3": (22, 60)}
BANNED = ("連結", "漬", "髮質", "每次", "罐", "凍")
CTA = ("hold", "point")


def plan_table(spark: SparkSession) -> DataFrame:
    """A row per structure and shot: the small dimension that shots are joined to."""
    rows = [(s, i, *shot, *TIMING[s]) for s, plan in PLANS.items() for i, shot in enumerate(plan)]
    return spark.createDataFrame(rows, "structure string, pos int, framing string, expression string, hand string, point boolean, smile boolean, t_talk string, t_end string, length int")


def parse_specs(raw: DataFrame, column: str = "raw") -> DataFrame:
    """raw documents with spec (typed) next to the text; keys unknown to the schema are found by violations()."""
    return raw.withColumn("spec", F.from_json(column, SCHEMA))


def _kind(document: Column, path: str = "$") -> Column:
    """The type of what stands at the path of a variant; null if nothing does."""
    return F.schema_of_variant(F.try_variant_get(document, path, "variant"))


def _field_errors(document: Column, fields: dict[str, str], where: Column) -> Column:
    """array of unknown:, required:, type: and blank: codes of one object; where is what its keys are led by."""
    code = lambda what, key: F.concat(F.lit(f"{what}:"), where, key if isinstance(key, Column) else F.lit(key))
    keys = F.coalesce(F.json_object_keys(F.to_json(document)), F.array().cast("array<string>"))
    found = [F.transform(F.array_sort(F.array_except(keys, F.array(*map(F.lit, fields)))), lambda k: code("unknown", k))]
    for key, rule in fields.items():
        kind, wanted = _kind(document, f"$.{key}"), rule.lstrip("!")
        blank = F.trim(F.try_variant_get(document, f"$.{key}", "string")) == "" if wanted == "text" else F.lit(False)
        missing = F.when(kind.isNull(), code("required", key) if rule != wanted else F.lit(None).cast("string"))
        found.append(F.array_compact(F.array(F.when(kind.isNull(), missing).when(~kind.rlike(KINDS[wanted]), code("type", key)).when(blank, code("blank", key)))))
    is_object = F.coalesce(_kind(document), F.lit("")).startswith("OBJECT")
    return F.when(is_object, F.concat(*found)).otherwise(F.array(F.concat(F.lit("type:"), where)))


def violations(specs: DataFrame) -> DataFrame:
    """specs with errors: array of codes, empty if the document is valid.

    Types are those of the raw document, so a number is not taken for a text;
    every shot is checked.  What is not JSON has the one error type:.
    """
    s = lambda path: F.col(f"spec.{path}")
    document = F.try_parse_json(F.col("raw"))
    structure, cta = F.coalesce(s("structure"), F.lit("5")), F.coalesce(s("cta"), F.lit("hold"))
    errors = [_field_errors(document, FIELDS[""], F.lit(""))]
    for part in ("person", "product"):
        inner = F.try_variant_get(document, f"$.{part}", "variant")
        errors.append(F.when(F.coalesce(_kind(document, f"$.{part}"), F.lit("")).startswith("OBJECT"), _field_errors(inner, FIELDS[part], F.lit(f"{part}."))).otherwise(F.array().cast("array<string>")))
    shots = F.try_variant_get(document, "$.shots", "array<variant>")
    each = F.transform(shots, lambda x, i: _field_errors(x, FIELDS["shots"], F.concat(F.lit("shots["), i.cast("string"), F.lit("]."))))
    errors.append(F.coalesce(F.flatten(each), F.array().cast("array<string>")))

    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    joined = F.transform(s("shots"), lambda x: F.array_join(x["line"], ""))
    han = F.transform(joined, texts.han_count)
    size = reduce(lambda c, kv: c.when(structure == kv[0], len(kv[1])), PLANS.items(), F.when(F.lit(False), 0))
    most = reduce(lambda c, kv: c.when(structure == kv[0], kv[1][0]), CHARS.items(), F.when(F.lit(False), 0))
    least = reduce(lambda c, kv: c.when(structure == kv[0], kv[1][1]), CHARS.items(), F.when(F.lit(False), 0))
    as_texts = F.forall(shots, lambda x: F.coalesce(_kind(x, "$.line").isin("ARRAY<STRING>"), F.lit(True)))
    two = as_texts & F.forall(s("shots"), lambda x: F.coalesce((F.size(x["line"]) == 2) & F.forall(x["line"], lambda t: ~blank(t)), F.lit(False)))
    clean = F.forall(s("shots"), lambda x: F.forall(x["line"], lambda t: (F.trim(t) == t) & ~t.rlike("[\n，]")))
    banned = F.exists(joined, lambda t: F.exists(F.array(*map(F.lit, BANNED)), lambda w: F.contains(t, w)))
    checks = [
        (~texts.good_package(s("package")), "package"), (~texts.good_prefix(s("shot_prefix")), "shot_prefix"),
        (~structure.isin(*PLANS), "structure"), (~cta.isin(*CTA), "cta"),
        (s("shots").isNotNull() & (F.size(s("shots")) != size), "shots"), (~two, "line"), (~clean, "half"), (banned, "banned"),
        (F.exists(han, lambda n: n > most), "shot_length"), (F.aggregate(han, F.lit(0), lambda a, n: a + n) < least, "package_length"),
    ]
    errors.append(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), code) for c, code in checks])))
    return specs.withColumn("errors", F.when(document.isNull(), F.array(F.lit("type:"))).otherwise(F.concat(*errors)))


def expand(specs: DataFrame, spark: SparkSession) -> DataFrame:
    """A row per shot with its plan, timing and shot_id."""
    shots = specs.select("spec", F.coalesce("spec.structure", F.lit("5")).alias("structure"), F.posexplode("spec.shots").alias("pos", "shot"))
    plan = plan_table(spark).withColumnRenamed("structure", "__s").withColumnRenamed("pos", "__p")
    met = shots.join(F.broadcast(plan), (F.col("structure") == F.col("__s")) & (F.col("pos") == F.col("__p"))).drop("__s", "__p")
    return met.withColumn("shot_id", F.concat("spec.shot_prefix", (F.col("pos") + 1).cast("string")))


def fill(template: str, values: dict[str, Column]) -> Column:
    """The template with {name} replaced; braces inside the values are left as they are, {{ and }} give braces."""
    parts, text = [], template.replace("{{", "\0").replace("}}", "\1")
    while text:
        head, _, rest = text.partition("{")
        if head:
            parts.append(F.lit(head.replace("\0", "{").replace("\1", "}")))
        name, _, text = rest.partition("}")
        if name:
            parts.append(F.coalesce(values[name], F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


#: Short texts of our own; a package of templates is a dict like this one, e.g. read from a JSON file.
TEMPLATES = {
    "image": "Place: {scene} Camera: {framing} Clothes: {outfit}. Hair: {hair} Hands: {hands} Expression: {expression}.",
    "video": "{scene}; {outfit}. {hands} Camera {framing}, edges on {anchors}.\n[0.0s-{t_talk}s] {line} [{t_talk}s-{t_end}s] {end}\n",
    "voiceover": "{first}\n{second}\n",
    "hold": "holds the {look} in the {hand} hand, {grip}, size {size}.",
    "point": " The {other} hand points down.",
    "no_hands": "out of the picture.",
    "grip": "an easy grip",
    "hair": "neat.",
    "smile": "a soft smile.",
    "calm": "a calm face.",
    "line": "{first}，{second}",
}


def render(shots: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(package, shot_id, kind, path, text), three rows per shot."""
    t, c = templates, F.col
    point = c("point") & (F.coalesce("spec.cta", F.lit("hold")) == "point")
    hold = fill(t["hold"], {"look": c("spec.product.look_qwen"), "hand": c("hand"), "grip": F.coalesce("spec.product.grip", F.lit(t["grip"])), "size": c("spec.product.size")})
    other = F.when(c("hand") == "left", "right").otherwise("left")
    hands = F.when(c("hand").isNull(), t["no_hands"]).otherwise(F.concat(hold, F.when(point, fill(t["point"], {"other": other})).otherwise("")))
    hair = F.when((c("pos") == 0) & c("spec.shot1_hair_qwen").isNotNull(), c("spec.shot1_hair_qwen")).otherwise(t["hair"])
    first, second = F.get("shot.line", 0), F.get("shot.line", 1)
    end = F.when(c("smile"), t["smile"]).otherwise(t["calm"])
    image = fill(t["image"], {"scene": c("shot.scene_qwen"), "framing": c("framing"), "outfit": c("shot.outfit"), "hair": hair, "hands": hands, "expression": c("expression")})
    video = fill(t["video"], {"scene": c("shot.scene_video"), "outfit": c("shot.outfit"), "hands": hands, "framing": c("framing"), "anchors": c("shot.anchors"), "t_talk": c("t_talk"), "t_end": c("t_end"), "line": fill(t["line"], {"first": first, "second": second}), "end": end})
    voice = fill(t["voiceover"], {"first": first, "second": second})
    row = lambda kind, path, text: F.struct(F.lit(kind).alias("kind"), path.alias("path"), text.alias("text"))
    ident = c("shot_id")
    files = F.array(row("image", F.concat(F.lit("_qwen指令/q_"), ident, F.lit(".txt")), image), row("video", F.concat(F.lit("prompt_"), ident, F.lit("D.txt")), video), row("voiceover", F.concat(F.lit("口白腳本_"), ident, F.lit("D.txt")), voice))
    return shots.select(c("spec.package").alias("package"), "shot_id", F.explode(files).alias("f")).select("package", "shot_id", "f.kind", "f.path", "f.text")
