import pytest

from quernstone.llm import answers

VI = "Trong không gian Oxyz, cho mặt phẳng (P) và hai điểm A, B. Tính khoảng cách từ A đến mặt phẳng đó theo đơn vị mét?"
SOLVED = "Áp dụng công thức khoảng cách ta được kết quả 5. Vậy chọn đáp án B."


@pytest.mark.parametrize("response", [None, "", " \n", "...", "-", "null", "N/A", "[]", "Lời giải:", "Giải thích: ", "Solution:", "Hướng dẫn giải."])
def test_empty(response):
    assert answers.defects_of("short_answer", VI, None, response) == ["empty"]


@pytest.mark.parametrize("answer,bad", [("A", False), (" d ", False), ("Đáp án C", False), ("B.", False), (None, True), ("", True), ("N/A", True), ("?", True), ("null", True), ("-", True)])
def test_letters(answer, bad):
    assert answers.defects_of("multiple_choice", VI, answer, SOLVED) == (["empty"] if bad else [])
    assert answers.defects_of("true_false", VI, answer, SOLVED) == []


@pytest.mark.parametrize("response", ["Tôi xin phép không giải câu hỏi này ạ.", "Xin lỗi, tôi không thể trả lời yêu cầu này.", "Rất tiếc, đề bài bị thiếu nên tôi không đưa ra lời giải.", "Toi xin phep khong giai cau hoi nay."])
def test_refusal(response):
    assert answers.defects_of("short_answer", VI, None, response) == ["refusal"]


def test_a_solution_that_cannot_divide_is_none():
    english = "The writer doubts that the bell tower helps the farmer. What is the distance from the tower to the wall in line 3?"
    assert answers.defects_of("short_answer", english, None, "We cannot divide by zero here, therefore x is left out. So the correct answer is D.") == []
    assert answers.defects_of("short_answer", english, None, "I must decline to answer item 3.") == ["refusal"]


@pytest.mark.parametrize("response,cut", [
    ("Số cách chọn là tích của 3 và 4. Áp dụng công thức khoảng cá", True), ("Ta được kết quả 5 và", True), ("Đặt $t=3x$, điều kiện $t>", True), ("Ta có (P", True),
    ("Ta được kết quả 5. Chọn B", False), ("Ta được 5. Đáp số: 35 độ", False), ("Suy ra giá trị cần tìm bằng $4$", False), ("$27x=68\\Rightarrow x=72$", False), (SOLVED + " (easy)", False),
])
def test_truncated(response, cut):
    assert ("truncated" in answers.defects_of("short_answer", VI, None, response)) == cut


def test_copy():
    assert answers.defects_of("short_answer", VI, None, VI.upper()) == ["copy"]
    assert answers.defects_of("short_answer", VI, None, "Lời giải: " + VI.replace("hai điểm", "các điểm")) == ["copy"]
    assert answers.defects_of("short_answer", VI, None, VI.split(".")[0] + ". " + SOLVED * 2) == []
    assert answers.defects_of("short_answer", None, None, SOLVED) == []


def test_suffix_automaton_agrees_with_brute_force():
    import random

    rng = random.Random(2)
    for _ in range(60):
        text, other = ([rng.choice("abc") for _ in range(rng.randrange(0, 14))] for _ in range(2))
        runs = {tuple(text[i:j]) for i in range(len(text)) for j in range(i + 2, len(text) + 1)}
        covered = {k for i in range(len(other)) for j in range(i + 2, len(other) + 1) if tuple(other[i:j]) in runs for k in range(i, j)}
        assert answers.SuffixAutomaton(text).covered(other, 2) == len(covered)


def test_language():
    assert answers.defects_of("short_answer", VI, None, "The plane does not contain the point, so the distance is positive and the value is found.") == ["language"]
    assert answers.defects_of("short_answer", VI, None, "Mat khac, do ban kinh day luon duong nen loai gia tri nay. Vay chon dap an B.") == []
    assert answers.defects_of("short_answer", VI, None, "Le plan ne contient pas le point, donc la distance est positive et on obtient la somme.") == ["language"]
    assert answers.defects_of("short_answer", VI, None, "(Key concept: derivative test) " + SOLVED) == []


def test_operator(rows, listed):
    frame = rows([("1", "short_answer", VI, None, ""), ("1", "short_answer", VI, None, ""), ("2", None, None, None, None), ("3", "true_false", VI, None, SOLVED), ("4", "short_answer", VI, None, "từ " * 50_000)], "id string, kind string, question string, answer string, response string")
    assert listed(answers.defects(frame)) == [("1", "empty"), ("2", "empty"), ("4", "truncated")]
    assert answers.defects(frame.limit(0)).count() == 0


def test_words_after_many_marks_are_content():
    assert not answers.is_empty("." * 300 + " the solution is 5")
    assert not answers.is_empty("null " + "-" * 300 + " the solution is 5")
    assert answers.is_empty("." * 300) and answers.is_empty("null " + "-" * 300)


@pytest.mark.parametrize("text,is_open", [
    ("(a + b]", True), ("(a + b)", False), ("[1; 2) và (3, 4]", False), ("{[x]}", False), ("a) một b) hai", False), ("(xem a) và b)", False), ("[(x)", True), ("{(x})", True), ("", False),
])
def test_stack_of_delimiters(text, is_open):
    assert answers.left_open(text) == is_open


def test_each_defect_is_told():
    cut = "Xin lỗi, tôi không thể giải bài này vì"
    assert answers.defects_of("multiple_choice", VI, None, cut) == ["empty", "refusal", "truncated"]
    assert answers.defects_of("short_answer", VI, None, VI.rsplit(" ", 2)[0]) == ["copy", "truncated"]
    assert answers.defects_of("short_answer", VI, None, "I am unable to solve this problem because it is not") == ["refusal", "truncated", "language"]


@pytest.mark.parametrize("response", ["Xin lỗi, mình chưa thể giải câu này.", "Em chưa thể hỗ trợ bài này.", "I can't do this one.", "I won't be solving it.", "Tôi từ chối trả lời."])
def test_other_refusals(response):
    assert "refusal" in answers.defects_of("short_answer", VI, None, response)
