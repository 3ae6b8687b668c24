import numpy as np
import pytest
from pyspark.sql import functions as F

from siftstone.operators import images as I
from siftstone.operators import photo as P
from siftstone.operators import verdicts as V


def blank(h=900, w=900):
    return np.full((h, w, 3), 255, dtype=np.uint8)


def boxed(image, x0, y0, x1, y1, colour=(30, 60, 90)):
    image[y0:y1, x0:x1] = colour
    return image


def flood(mask, eight):
    labels, n = np.zeros(mask.shape, int), 0
    near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (eight or not (a and b))]
    for y, x in zip(*np.nonzero(mask), strict=True):
        if not labels[y, x]:
            n, todo = n + 1, [(y, x)]
            labels[y, x] = n
            while todo:
                a, b = todo.pop()
                for dy, dx in near:
                    c, d = a + dy, b + dx
                    if 0 <= c < mask.shape[0] and 0 <= d < mask.shape[1] and mask[c, d] and not labels[c, d]:
                        labels[c, d] = n
                        todo.append((c, d))
    return labels


@pytest.mark.parametrize("eight", (True, False))
def test_components_against_flood(eight):
    rng = np.random.default_rng(3)
    for shape in ((1, 1), (1, 9), (9, 1), (23, 31), (40, 17)):
        for share in (0, 0.3, 0.5, 0.7, 1):
            mask = rng.random(shape) < share
            labels, stats = I.components(mask, eight)
            expected = flood(mask, eight)
            assert (labels == expected).all() and len(stats) == expected.max(initial=0)
            for k, s in enumerate(stats, 1):
                ys, xs = np.nonzero(expected == k)
                assert s == {"area": len(ys), "x0": xs.min(), "y0": ys.min(), "x1": xs.max() + 1, "y1": ys.max() + 1}


def test_masks_against_definitions():
    rng = np.random.default_rng(5)
    mask = rng.random((20, 26)) < 0.1
    padded = np.pad(mask, 2)
    assert (P.dilate(mask, 5) == [[padded[y : y + 5, x : x + 5].any() for x in range(26)] for y in range(20)]).all()
    assert (P.erode(mask, 5) == ~P.dilate(~mask, 5)).all()
    ys, xs = np.nonzero(~mask)
    py, px = np.nonzero(mask)
    assert P.distance(mask, ys, xs) == pytest.approx([np.hypot(py - y, px - x).min() for y, x in zip(ys, xs, strict=True)])


def test_a_clean_box_breaks_no_rule():
    m = P.measure("p", boxed(blank(), 100, 80, 820, 830))
    assert (m["width"], m["height"], m["objects"], m["mark_gap"], m["crosses_text"], m["faint_marks"], m["bar"], m["inner_bar"]) == (720, 750, 1, None, False, 0, None, None)
    assert m["slant"] == 0 and m["rect"] == m["symmetry"] == 1 and not m["second_face"] and m["white"] == 0 and m["paint"] == [] and m["edges"] == []


def test_marks():
    image = boxed(boxed(blank(), 100, 200, 820, 830), 400, 150, 430, 180)
    m = P.measure("p", image)
    assert m["mark_gap"] == 20 and [(p["kind"], p["gap"]) for p in m["paint"]] == [("mark", 20)] and (m["width"], m["height"]) == (720, 630)
    assert m["paint"][0] | {"x0": 397, "y0": 147, "x1": 433, "y1": 183} == m["paint"][0]
    m = P.measure("p", boxed(boxed(blank(), 100, 200, 820, 830), 400, 160, 430, 198))
    assert m["mark_gap"] == 2 and m["paint"] == []
    image = boxed(blank(), 200, 200, 700, 700)
    for x, y in ((20, 300), (20, 400), (20, 500), (800, 300), (800, 400), (300, 20), (400, 20)):
        boxed(image, x, y, x + 12, y + 12, (200, 200, 200))
    m = P.measure("p", image)
    assert (m["faint_marks"], m["mark_sides"]) == (7, 3)


def test_lines_of_text():
    image = boxed(blank(), 200, 100, 700, 800)
    for x in (60, 90, 120, 150):
        boxed(image, x, 400, x + 20, 430)
    m = P.measure("p", image)
    assert m["crosses_text"] is False and m["mark_gap"] == 30 and m["paint"][0]["kind"] == "text" and len(m["paint"]) == 1
    image = blank()  # a frame round a clear middle that the border reaches from above: characters within the product's box
    boxed(boxed(boxed(image, 200, 100, 260, 800), 640, 100, 700, 800), 200, 740, 700, 800)
    for x in (340, 370, 400):
        boxed(image, x, 300, x + 20, 330)
    assert P.measure("p", image)["inner_text"] == 1
    image = blank()
    boxed(boxed(boxed(image, 200, 100, 260, 800), 640, 100, 700, 800), 200, 740, 700, 800)
    for x in (90, 120, 150, 170, 270, 300):
        boxed(image, x, 300, x + 15, 360)
    m = P.measure("p", image)
    assert m["crosses_text"] and m["width"] == 610 and m["mark_gap"] is None and m["bar"] is None


def test_bands_and_faces():
    image = boxed(blank(), 300, 50, 600, 850)
    boxed(image, 200, 400, 700, 460, (200, 30, 30))
    assert P.measure("p", image)["bar"] == 0
    boxed(image, 210, 410, 230, 450, (250, 250, 90))
    assert P.measure("p", image)["bar"] > 0.02
    image = boxed(boxed(blank(), 200, 50, 700, 850), 200, 400, 700, 480, (230, 200, 40))
    boxed(image, 300, 420, 420, 460, (20, 20, 20))
    m = P.measure("p", image)
    assert m["inner_bar"] == pytest.approx(0.1) and m["bar"] is None
    for turn in (False, True):
        image = boxed(boxed(blank(), 200, 200, 700, 700), 200, 200, 300, 700, (120, 150, 180))
        m = P.measure("p", image.transpose(1, 0, 2).copy() if turn else image)
        assert m["second_face"] and m["slant"] == 0
    y, x = np.mgrid[:900, :900]
    image = blank()
    image[(x > 200 + (y - 100) * 0.25) & (x < 650) & (y >= 100) & (y < 800)] = 40
    m = P.measure("p", image)
    assert m["slant"] == pytest.approx(np.degrees(np.arctan(0.25)), abs=0.5) and m["symmetry"] < 0.92
    # 90 degrees off an axis is on the other one
    assert P.slant(np.ones((1, 1), bool)) == 0


def test_blank_and_clear_images():
    assert P.measure("p", blank(30, 30))["foreground"] == 0
    assert P.measure("p", None)["readable"] is False
    alpha = np.zeros((900, 900), np.uint8)
    alpha[100:800, 100:800] = 255
    m = P.measure("p", np.zeros((900, 900, 3), np.uint8), alpha)
    assert (m["width"], m["uniform"], m["white"], m["faint_marks"]) == (700, None, None, None)
    assert P.flatten(blank(3, 3), np.full((3, 3), 255, np.uint8))[1] is None


def test_photos_end_to_end(spark, tmp_path):
    from siftstone.sources.readers import read_pixels
    from siftstone.sources.sinks import encode_png

    slim = boxed(blank(), 100, 80, 400, 830)
    images = {"ok": boxed(blank(), 100, 80, 820, 830), "near": boxed(boxed(blank(), 100, 200, 820, 830), 400, 160, 430, 198), "slim": slim, "small": boxed(blank(), 100, 100, 400, 300)}
    for name, image in images.items():
        (tmp_path / f"{name}.png").write_bytes(encode_png(image))
    (tmp_path / "bad.png").write_bytes(b"no image")
    m = F.struct("*")
    photos = P.measured(read_pixels(spark, str(tmp_path))).select("path", V.rules(m).alias("reasons"), V.delegated(m).alias("open"), V.suggestions(m).alias("hints"))
    got = {r.path.rsplit("/", 1)[1][:-4]: r for r in photos.withColumn("verdict", V.verdict(F.col("reasons"))).collect()}
    assert {k: (r.verdict, [x.code for x in r.reasons]) for k, r in got.items()} == {
        "ok": ("要人眼", ["long700-999"]), "near": ("要人眼", ["near-mark", "long700-999"]), "slim": ("要人眼", ["long700-999"]), "small": ("不收", ["long<700", "h<600"]), "bad": ("不收", ["read"]),
    }
    assert all(r.open == [] and r.hints == [] for r in got.values())


def test_open_questions_and_judges(spark):
    judge = V.NullJudge()
    rows = [(1, [("要人眼", "bg")], ["front_view"]), (2, [("不收", "read")], ["added_text"]), (3, [], [])]
    df = spark.createDataFrame(rows, "id long, reasons array<struct<level:string,code:string>>, open array<string>")

    class Stern(V.Judge):
        def ask(self, row, questions):
            return {"status": "ok", "answers": {q: q == "added_text" for q in questions}}

    class Broken(V.Judge):
        def ask(self, row, questions):
            raise OSError("gone")

    def after(j):
        return {r.id: (r.status, [x.code for x in r.after]) for r in V.screened_by(df, j).collect()}

    assert after(judge) == {1: ("not_connected", ["bg", "judge:front_view"]), 2: ("skipped", ["read", "judge:added_text"]), 3: ("not_connected", [])}
    assert after(Broken())[3] == ("error: OSError: gone", [])
    assert after(Stern())[3] == ("ok", ["model:single_product", "model:front_view", "model:added_text"]) and after(Stern())[2] == ("skipped", ["read", "judge:added_text"])
