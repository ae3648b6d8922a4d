import json

import numpy as np

from quernstone.llm import scans
from quernstone.llm.boosting import BoostedTrees


def test_boosting_learns_and_is_defined_on_one_class():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = (x[:, 0] > 0) ^ (x[:, 1] > 0.5)
    model = BoostedTrees(rounds=40, depth=3).fit(x[:1500], y[:1500])
    assert ((model.predict(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert BoostedTrees().fit(x, np.zeros(2000)).predict(x[:3]).max() < 0.5
    assert BoostedTrees().fit(np.zeros((0, 4)), np.zeros(0)).predict(np.zeros((0, 4))).shape == (0,)


def test_json_of_page_items():
    assert scans.lines_of_json('{"question_text": "a\\nb"}') == "a\nb"
    assert [scans.lines_of_json(x) for x in (None, "", "{", '{"question_text": null}', "[1]", '"x"', '{"question_text": "cut')] == [None] * 7


def test_skeletons_of_misread_words():
    for seen, meant in (("the0", "theo"), ("cùn9", "cùng"), ("frorn", "from"), ("c1ay", "clay"), ("raclius", "radius"), ("vecto'", "vectơ"), ("đuờng", "đường"), ("kh|ến", "khiến"), ("wa1l", "wall")):
        assert scans.skeleton(seen) == scans.skeleton(meant), (seen, meant)


def test_cells_of_tables():
    lines = ["text goes on here.", "Nhóm", "[1;3)", "[3;5)", "[5;7)", "Tần số", "4", "-", "9", "Text follows,", "12", "more"]
    assert [k for k, x in enumerate(scans.table_cells(lines)) if x] == [2, 3, 4, 6, 7, 8]


def noisy(k):
    words = f"khoảng cách giữa hai điểm trong không gian bằng {k} mét thì diện tích hình phẳng thay đổi theo hàm số đã cho trước".split()
    lines = [" ".join(words[i : i + 5]) for i in range(0, len(words), 5)]
    scan = list(lines)
    if k % 2:
        scan.insert(2, f"TRUNG TÂM LUYỆN ĐỀ Số {k % 5}")
        scan.insert(0, f"Trang {k}/99")
    if k % 3 == 0:
        scan[-1] = scan[-1].replace("trước", "tru-") if scan[-1].endswith("trước") else scan[-1]
        scan.append("ớc" if scan[-1].endswith("tru-") else "")
    scan = [line.replace("trong", "tr0ng") if k % 4 == 0 else line for line in scan]
    return "\n".join(scan), " ".join(words)


def test_noise_of_made_up_pages(spark, rows, listed):
    pages = [(str(k), *noisy(k)) for k in range(1, 160)]
    bank = [(key, json.dumps({"question_text": scan}, ensure_ascii=False), clean) for key, scan, clean in pages]
    frame = rows(bank + [("x", "{broken", "text"), ("y", None, None), ("1", bank[0][1], bank[0][2])], "key string, raw string, clean string")
    from pyspark.sql import functions as F

    table = "khoảng cách giữa hai điểm trong không\n[1;3)\n[3;5)\n[5;7)\nTần số\nCount\n4\n12\n9\ngian bằng 7 mét thì diện tích"
    blocks = rows([("table", table), ("one", "khoảng cách giữa hai điểm bằng 5 mét"), ("number", "17")], "row_key string, text string")
    texts = scans.scanned(blocks, frame.select(F.col("key").alias("row_key"), "raw"))
    looked, meant, _ = scans.study(texts, frame.select(F.col("clean").alias("text")), frame)
    found = {(r.row_key, r.line_no, r.defect) for r in scans.defects(looked, meant).collect()}
    assert not {f for f in found if f[0] in ("table", "one")}  # cells and labels of a table, a text of one line
    for key, scan, _ in pages:
        for n, line in enumerate(scan.split("\n"), 1):
            assert ((key, n, "page_number") in found) == line.startswith("Trang "), line
            assert ((key, n, "header") in found) == line.startswith("TRUNG TÂM"), line
            assert ((key, n, "misread") in found) == ("tr0ng" in line), line
    repaired = {r.row_key: r.text for r in scans.repaired(texts, looked, meant).collect()}
    clean = {key: c for key, _, c in pages}
    assert all(repaired[key] == clean[key] for key in clean if int(key) % 3)


def test_empty_tables_and_clean_texts(spark, rows):
    none = rows([], "source_table string, row_key string, text string")
    looked, meant, _ = scans.study(none, rows([], "text string"), rows([], "key string, raw string, clean string"))
    assert scans.defects(looked, meant).count() == 0
    some = rows([("t", "1", "one line"), ("t", "2", ""), ("t", "3", "a\n\nb")], "source_table string, row_key string, text string")
    looked, meant, _ = scans.study(some, rows([], "text string"), rows([], "key string, raw string, clean string"))
    assert scans.defects(looked, meant).count() == 0


def test_flat_texts_are_repaired_by_the_lines_of_their_blocks(spark, rows):
    keys = "source_table string, row_key string, "
    block = "so far thE0ry is\nPAGE 7\nwell under-\nstood here.\n\nNext one."
    flats = rows(
        [("1", " ".join(block.split()), block), ("2", "so far thE0ry is PAGE 7 very well under- stood here. Next one.", block),
         ("3", "thE0ry", None), ("4", "so far PAGE 8 is well", block)],
        "row_key string, flat string, block string",
    )
    assert {r.row_key for r in scans.strays(flats).collect()} == {"2", "3", "4"}
    seen = [(1, "text", ["the0ry"]), (2, "page_number", []), (3, "broken", [])]
    looked = [("m", key, *x) for key in "124" for x in seen] + [(scans.FLAT, "3", 1, "text", ["the0ry"])]
    looked = rows(looked, keys + "line_no int, kind string, odd array<string>")
    meant = rows([("the0ry", "theory")], "word string, meant string")
    got = {r.row_key: r.text for r in scans.repaired_flat(flats, looked, meant, "m").collect()}
    assert got["1"] == "so far theory is well understood here.\nNext one."
    assert got["2"] == "so far theory is very well understood here.\nNext one."
    assert got["3"] == "theory" and "PAGE 8" in got["4"]


def test_every_scanned_column_is_repaired(spark, root):
    from quernstone.llm import queries
    from quernstone.runtime import table

    got = queries.p4_repaired(spark, root).where("field = 'question_text'")
    pages = table(spark, root, "mineru_preview_10_questions").where("question_text is not null")
    assert sorted(r.row_key for r in got.collect()) == sorted(str(r.ordinal) for r in pages.select("ordinal").distinct().collect())


def test_stray_misreadings_among_many_clean_texts_hide_none(spark, rows):
    """The clean texts a hundred times over, some with the misreading itself: it is still told from a word."""
    pages = [(str(k), *noisy(k)) for k in range(1, 160)]
    frame = rows([(key, json.dumps({"question_text": scan}, ensure_ascii=False), clean) for key, scan, clean in pages], "key string, raw string, clean string")
    from pyspark.sql import functions as F

    clean = frame.select(F.explode(F.array_repeat("clean", 100)).alias("text")).unionByName(rows([("khoảng cách tr0ng không gian",)] * 60, "text string"))
    texts = scans.scanned(rows([], "row_key string, text string"), frame.select(F.col("key").alias("row_key"), "raw"))
    looked, meant, _ = scans.study(texts, clean, frame)
    found = {(r.row_key, r.line_no) for r in scans.defects(looked, meant).where("defect = 'misread'").collect()}
    assert found == {(key, n) for key, scan, _ in pages for n, line in enumerate(scan.split("\n"), 1) if "tr0ng" in line}


def test_strays_are_relative(rows):
    counted = rows([("trong", 10_000), ("tr0ng", 100), ("đường", 5000), ("đuờng", 51), ("hiếm", 1)], "word string, n long")
    assert {r.word for r in scans.with_strays(counted).where("stray").collect()} == {"tr0ng"}
    doubled = counted.selectExpr("word", "n * 1000 as n")
    assert {r.word for r in scans.with_strays(doubled).where("stray").collect()} == {"tr0ng"}
