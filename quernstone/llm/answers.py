"""Defects of prompt and response pairs (problem 6).

Method, one test for each defect:
  empty      nothing is left of the response once headings and marks are taken away
  refusal    an automaton of refusal phrases, matched word by word, accents aside
  copy       a suffix automaton of the prompt's words measures how much of the response is
             covered by runs copied from it
  truncated  a stack of delimiters is left open, or the last sentence neither ends nor is a
             conclusion that needs no full stop
  language   stop-word votes: the language with most votes for the response is another than
             that of the prompt

Each test is made on its own, so a pair has every defect that is found.  Only an empty response
ends the matter: it holds nothing that the other tests could read.

Defined results: null, blank and pseudo-null responses are ``empty``; a null prompt cannot be
copied and sets no language; a multiple-choice pair whose answer field holds no letter A-D is
``empty`` as well; repeated rows of an id are one; whole texts of any length are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.canonical import fold
from quernstone.llm.forms import one_form

# Spellings of no content.
PSEUDO_NULL = ("null", "none", "n/a", "na", "nan", "nil", "undefined", "khong co", "chua co", "trong")
_NULL_WORDS = max(len(words.replace("/", " ").split()) for words in PSEUDO_NULL)
# Headings of a response, in folded letters.
HEADING = re.compile(
    r"\s*(?:loi giai(?: chi tiet)?|giai thich|huong dan(?: giai)?|giai|bai giai|dap an|tra loi|ta co|solution|explanation|answer|response|we have|given|de bai|cau hoi|question)\s*[:.\-–]\s*"
)
# What a response says that declines; words between | are choices, * is up to three words.
REFUSALS = """
nam ngoai kha nang
vuot qua kha nang
khong dua ra loi giai
khong|chua the dua ra loi giai|dap an|cau
khong duoc phep lam|giai|tra|cung|ho
tu choi tao|cung|tra|giai|dua|thuc|ho
xin phep khong giai|tra|dua|lam|tiep|thuc
xin phep tu choi
khong|chua the giai|giup|ho|cung|thuc|dap|lam * yeu|cau|noi|bai|tro|ban|de
khong|chua the tra loi
xin loi * khong the|giai|tra
rat tiec * khong the|giai|tra|dua
la mot mo hinh ngon ngu
la mot cong cu ngon ngu
la mot tro ly
as a|an language|ai model|assistant|tool
not allowed to solve|answer|provide|help|do
beyond what i can
beyond my ability|abilities|capabilities|scope
must|have decline
decline to answer|solve|provide|help
decline this request
will not provide|solve|answer|give
won t provide|solve|answer|give|be
unable to answer|solve|help|provide|assist|complete|give
cannot help|assist|answer|solve|provide|fulfill|fulfil|comply|complete
can t help|assist|answer|solve|provide|fulfill|comply|complete
could not provide|answer|solve
i m sorry
i am sorry
i can|won|couldn t
i cannot|refuse|decline
i am|m unable
i am|m not able|allowed|permitted
i will not
i must decline|refuse
toi khong|chua the
toi|minh|em xin phep
toi|minh|em tu choi
refuses to answer|solve|create|provide|generate
refused to answer|solve|create|provide|generate
"""
# Frequent words of each language, folded.
STOPWORDS = {
    "vi": "la cua va cho trong mot nen duoc ta voi cac nhung khi thi co khong bang tinh tai nay do hai tren luon nhom so ket qua theo gia tri dieu kien dat tong vi mat khac thay lieu roi nghiem tim can neu den tu the nao bao nhieu khoang chon vay suy ra dap nam ve phia".split(),
    "en": "the of and to is in that we by from for with this so are was were be which on at as it an does not has had each after before because while when his her their therefore hence gives out other".split(),
    "fr": "le la les des et du est une un que dans pour nous ne pas en par donc avec sur sont au aux ce cette qui plus on obtient".split(),
    "es": "el la los las de del que y en un una por con para es se no al lo como obtenemos entonces su sus este esta".split(),
    "de": "der die das und ist nicht mit von wir den ein eine des dem zu im sich auf fur also daher ergibt sind wird".split(),
    "id": "yang dan dari dengan tidak sehingga pada adalah untuk kita tersebut ini itu di ke kemudian diperoleh sebesar selalu oleh karena".split(),
    "it": "il lo la gli le di del della che e un una per con non si da nel sono quindi".split(),
    "pt": "o a os as de do da que e em um uma para com nao por se dos das logo".split(),
}
LANGUAGES = tuple(STOPWORDS)
_VOTES: dict[str, list[int]] = {}
for _k, _words in enumerate(STOPWORDS.values()):
    for _word in _words:
        _VOTES.setdefault(_word, []).append(_k)
# Vietnamese typed without accents shares spellings with other languages; those count for none.
for _word, _of in _VOTES.items():
    if 0 in _of and len(_of) > 1:
        _VOTES[_word] = []
#: Votes a response needs for another language, and how many times those for the prompt's language.
LEAST_VOTES, MARGIN = 3, 2.0
#: Share of the response's words that must lie in copied runs of RUN words or more.
COPIED, RUN = 0.8, 3

_FORMULA = re.compile(r"\$[^$]*\$")
_WORD = re.compile(r"[^\W_]+")
_LETTER = re.compile(r"[^\W\d_]")
_BRACKETS = re.compile(r"[()\[\]{}]")
_OPENS = {")": "(", "]": "[", "}": "{"}
_SENTENCE = re.compile(r"[.!?…](?=\s|$)")
_CONCLUSION = re.compile(r"(?:nen |vay |do do |suy ra |so |therefore |thus |hence )*(?:ta )?(?:chon|dap so|dap an|suy ra|vay|ket luan|ket qua|do do|the final|final|therefore|hence|thus|so the|we choose|the answer|answer)\b")
_OPEN_END = re.compile(r"(?:[,:;(\[{=+\-–*/<>\\]|\b(?:bang|la|va|(?<!\d )do|suy ra|tuc la|vi|nen|voi|ta co|thi|ma|cua|tai|cho|and|which|gives|therefore|because|so|the|of|is|to|that|we|hence|where|but))$")
_UNIT_END = re.compile(r"(?:\$|\b[a-d]|\d\s+[^\W\d_][\w\- ]*|\d)$")


def _automaton() -> dict:
    """The refusal phrases as one automaton over words: a state is a dictionary of the next words."""
    root: dict = {}
    for line in REFUSALS.strip().splitlines():
        states = [root]
        for step in line.split():
            if step == "*":
                for state in states:
                    state.setdefault("*", {"any": 3})
                states = [state["*"] for state in states]
                continue
            states = [state.setdefault(word, {}) for state in states for word in step.split("|")]
        for state in states:
            state["end"] = True
    return root


_REFUSE = _automaton()


def refuses(words: list[str]) -> bool:
    """Runs of the automaton from each word at once; a wildcard state stays for up to three words."""
    live: list[tuple[dict, int]] = []
    for word in words:
        if not live and word not in _REFUSE:
            continue
        following = []
        for state, rest in [*live, (_REFUSE, 0)]:
            step = state.get(word)
            if step is not None:
                following.append((step, 0))
            if rest > 0:
                following.append((state, rest - 1))
        for state, _ in list(following):
            gap = state.get("*")
            if gap is not None:
                following.append((gap, gap["any"]))
        if any("end" in state for state, _ in following):
            return True
        live = following
    return False


class SuffixAutomaton:
    """Suffix automaton of a sequence of words."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for word in words:
            current = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            p = last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = current
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                if self.length[p] + 1 == self.length[q]:
                    self.link[current] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    while p >= 0 and self.next[p].get(word) == q:
                        self.next[p][word] = clone
                        p = self.link[p]
                    self.link[q] = self.link[current] = clone
            last = current

    def covered(self, words: list[str], run: int) -> int:
        """How many of ``words`` lie in a run of ``run`` or more that the sequence holds."""
        state = matched = 0
        total, upto = 0, 0
        for k, word in enumerate(words, 1):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            else:
                matched = 0
            if matched >= run:
                begin = max(upto, k - matched)
                total += k - begin
                upto = k
        return total


def _without_headings(folded: str) -> str:
    while found := HEADING.match(folded):
        folded = folded[found.end() :]
    return folded


def is_empty(folded: str) -> bool:
    """Whether the folded response has no content."""
    body = _without_headings(folded + " :")[:-2].strip()
    words: list[str] = []
    for found in _WORD.finditer(body):
        words.append(found.group())
        if len(words) > _NULL_WORDS:  # more words than any spelling of nothing has
            return False
    return not words or body.strip(" .") in PSEUDO_NULL or " ".join(words) in PSEUDO_NULL


def has_letter(answer: str | None) -> bool:
    if answer is None:
        return False
    text = fold(answer)
    return text.strip(" .") not in PSEUDO_NULL and any(word in ("a", "b", "c", "d") for word in _WORD.findall(text))


def left_open(text: str) -> bool:
    """Whether the stack of delimiters isn't empty at the end.

    A closing sign takes away the opening sign of its own kind only; of round and square ones
    each may close the other around two bounds, as in [1; 2).  A closing sign without an open
    one, as in a), counts for nothing.
    """
    stack: list[tuple[str, int]] = []
    for found in _BRACKETS.finditer(text):
        sign = found.group()
        if sign in "([{":
            stack.append((sign, found.end()))
        elif stack:
            opened, begin = stack[-1]
            inner = text[begin : found.start()]
            if opened == _OPENS[sign] or "}" != sign and opened != "{" and (";" in inner or "," in inner):
                stack.pop()
    return bool(stack)


def is_truncated(text: str) -> bool:
    """Whether a response, in the one form, breaks off."""
    if text.count("$") % 2:
        return True
    plain = _FORMULA.sub("$", text)
    if left_open(plain):
        return True
    plain = re.sub(r"\s*\([^()]*\)\s*$", "", plain).rstrip("\"'”’» ")
    if not plain or not _LETTER.search(plain):
        return False
    if plain.endswith(("...", "…")):
        return True
    if plain[-1] in ".!?":
        return False
    ends = [m.end() for m in _SENTENCE.finditer(plain)]
    last = fold(plain[ends[-1] :] if ends else plain).strip()
    if _OPEN_END.search(last):
        return True
    return not (_CONCLUSION.match(last) and _UNIT_END.search(last))


# Letters that only Vietnamese has.
_VIETNAMESE = re.compile("[ăđơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉĩịọỏốồổỗộớờởỡợụủũứừửữựỳỵỷỹ]")


def votes(text: str) -> list[int]:
    counts = [0] * len(LANGUAGES)
    accents = 0
    plain = _FORMULA.sub(" ", text)
    for word in _WORD.findall(plain.lower()):
        if word.isascii():
            for k in _VOTES.get(word, ()):
                counts[k] += 1
        elif _VIETNAMESE.search(word):
            accents += 1
    counts[0] += accents
    return counts


def language_of(form: str) -> str | None:
    counts = votes(form)
    best = max(range(len(counts)), key=counts.__getitem__)
    return LANGUAGES[best] if counts[best] >= LEAST_VOTES else None


def is_other_language(question: str, response: str) -> bool:
    """Whether the response is in another language than the question, both in the one form."""
    own = language_of(question)
    if own is None:
        return False
    counts = votes(response)
    return max(counts) >= LEAST_VOTES and max(counts) > MARGIN * counts[LANGUAGES.index(own)]


def copies(known: list[str], words: list[str]) -> bool:
    """Whether the words of a response are copied from those of the question."""
    if not words or not known:
        return False
    shared = set(known)
    if sum(word in shared for word in words) < COPIED * len(words):
        return False  # fewer words in common than must be covered
    return SuffixAutomaton(known).covered(words, min(RUN, len(words))) >= COPIED * len(words)


def defects_of(kind: str | None, question: str | None, answer: str | None, response: str | None) -> list[str]:
    """The defects of one pair, each text folded once for all tests."""
    form = one_form(response or "")
    folded = fold(form)
    if is_empty(folded):
        return ["empty"]
    asked = one_form(question or "")
    found = []
    if kind == "multiple_choice" and not has_letter(answer):
        found.append("empty")
    if refuses(_WORD.findall(folded)):
        found.append("refusal")
    if copies(_WORD.findall(fold(asked)), _WORD.findall(_without_headings(folded))):
        found.append("copy")
    if is_truncated(form):
        found.append("truncated")
    if is_other_language(asked, form):
        found.append("language")
    return found


def defects(pairs: DataFrame) -> DataFrame:
    """(id, defect) of ``pairs`` (id, kind, question, answer, response): a narrow map, no shuffle but for repeated rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds = [], []
            for key, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for defect in defects_of(*rest):
                    ids.append(key), kinds.append(defect)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(kinds, pa.string())], names=["id", "defect"])

    rows = pairs.select(F.col("id").cast("string"), "kind", "question", "answer", "response").where("id is not null")
    return rows.mapInArrow(run, "id string, defect string").distinct()
