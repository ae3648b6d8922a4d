from quernstone.llm import canonical

ENTRIES = [("t", 1, "Nguyên hàm tích phân"), ("t", 2, "Xác suất có điều kiện"), ("t", 3, "Lượng giác cơ bản"), ("u", 9, "Nguyên hàm tích phân")]


def test_join_agrees_with_brute_force(rows):
    values = ["nguyen ham tich phan", "Nguyn hm tích phân", "NH tích phân", "Bài 5: xac suat co dieu kien (tiếp)", "luwowngj giacs cow banr", "cơ bản Lượng giác", "Di truyền học", "xyz", "?", "a"]
    got = {(r.value, r.id): r.similarity for r in canonical.similarity_join(rows([("t", v) for v in values], "list string, value string"), rows(ENTRIES, "list string, id int, title string"), 0.3).groupBy("value", "id").agg({"similarity": "max"}).withColumnRenamed("max(similarity)", "similarity").collect()}
    meant = {}
    for v in values:
        for lst, i, title in ENTRIES:
            if lst != "t":
                continue
            e = set(canonical.grams(canonical.readings(title)[0]))
            best = max((len(g & e) / len(g | e) for g in (set(canonical.grams(w)) for w in canonical.readings(v))), default=0)
            if best >= 0.3:
                meant[(v, i)] = best
    assert {k: round(x, 9) for k, x in got.items()} == {k: round(x, 9) for k, x in meant.items()}


def test_records(rows, listed):
    records = [("1", "t", "Nguyên hàm tích phân"), ("2", "t", "nguyên hàm TP"), ("3", "t", "Di truyền học"), ("4", "t", None), ("5", "t", " N/A "), ("6", "t", "Chưa phân loại"), ("7", "t", ""), ("2", "t", "nguyên hàm TP"), ("8", "u", "Xac suat co dieu kien")]
    got = canonical.map_records(rows(records, "key string, list string, value string"), rows(ENTRIES, "list string, id int, title string"))
    assert listed(got) == [("2", "t", 1), ("3", "t", 0), ("8", "u", 0)]
    nothing = canonical.map_records(rows(records, "key string, list string, value string"), rows([], "list string, id int, title string"))
    assert {r.id for r in nothing.collect()} == {0}


def test_a_very_long_value(rows):
    records = rows([("1", "t", "từ " * 20_000)], "key string, list string, value string")
    assert canonical.map_records(records, rows(ENTRIES, "list string, id int, title string")).first().id == 0


def test_every_reading_is_joined(rows):
    """Three abbreviations of several meanings each, one of them twice: all ways are read."""
    assert len(canonical.readings("bt hs dt tt")) == 12 and len(canonical.readings("dt dt hs")) == 12
    last = "do thi he so bieu thuc the tich"
    values = rows([("t", "bt hs dt tt")], "list string, value string")
    got = canonical.similarity_join(values, rows([("t", 7, last)], "list string, id int, title string"), 0.95)
    assert [r.id for r in got.collect()] == [7]
    assert canonical.readings("dt " * 5000, 300) == [["dt"] * 5000]
