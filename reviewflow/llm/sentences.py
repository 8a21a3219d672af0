"""Sentence boundaries across languages and scripts -> sentence units of every text.

Method. Gaps are the places where a sentence could end. Scripts without spaces between words are segmented by a dictionary
word lattice (cheapest path over known words and unknown characters), and a space there is a gap, classified by the word before
it (final particle, or a word that can't end) and the word after it (opening word, or a word that can't open). Scripts with
spaces are treated by a terminator lattice: each full stop has the readings end, abbreviation, number, name part and ellipsis,
each with a cost from its neighbours, and the cheapest path through all readings gives the boundaries. Quotations and
brackets are paired first; no gap inside a pair is a boundary. Line breaks are boundaries unless the text is wrapped there.

The scripts decide, not the language column, which may be missing or wrong.

Defined results
* null, empty and blank texts have no sentence; any other text has at least one.
* positions count code points; ``start_pos`` is that of the first character that isn't white space.
* an empty table gives no rows; whole texts are read; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.storage import ship_package

# Abbreviations that something always follows (titles, references, units before a number).
OPEN_ABBREVIATIONS = (
    "mr mrs ms mx dr prof rev gen col capt lt sgt hon messrs mt no nos vol vols fig figs ch sec eq approx ca cf vs ed eds e.g i.e viz tel "
    "sr sra srta dra d da ud uds núm pág págs art cap av avda c/ nº "
    "nr abb tab kap std str z.b d.h u.a z.t bd hr fr frl ing dipl bzw evtl ggf inkl max min "
    "m mm mme mlle mgr env p.ex n° art chap éd "
    "г-н г-жа гр ул рис стр т.е т.к напр ок пр проф им см "
    "डॉ रु श्री प्रो د أ م ص"
)
# Abbreviations that may end a sentence.
CLOSE_ABBREVIATIONS = "etc usw p.m a.m st ave rd blvd inc ltd co corp jr sr u.s u.k ee.uu uu aprox ext d.c a.c руб коп т.д т.п др г гг тыс млн кг см шт ك د.ك"
# Words of scripts without spaces. Final particles end a sentence; open words can't end one; openers begin one.
FINALS = {
    "thai": "ครับ ค่ะ คะ นะคะ นะครับ จ้า จ้ะ จ๊ะ ฮะ ขอรับ",
    "japanese": "です ます ました ません でした だ た よ ね ですね ますね ました か かな わ ください",
    "chinese": "了 吗 呢 吧 啊 呀 嘛 的 啦 哦",
    "lao": "ເດີ້ ແດ່ ເນາະ ແລ້ວ ບໍ່ ດອກ",
    "khmer": "ហើយ ទេ ណា ផង ចុះ បាទ ចាស",
    "burmese": "တယ် ပါတယ် မယ် ပြီ လား သလား ပါ နော် ဘူး",
}
NOT_LAST = {
    "thai": "และ หรือ ที่ ของ กับ แต่ เพราะ รุ่น ราคา ใช้มา",
    "japanese": "の は が を に へ と で も や から より まで って こと その この あの",
    "chinese": "和 与 或 在 把 被 对 向 从 而 但 是 很 这 那 不",
    "lao": "ແລະ ຫຼື ທີ່ ຂອງ ກັບ ແຕ່ ເພາະ",
    "khmer": "និង ឬ ដែល របស់ ជាមួយ ប៉ុន្តែ ព្រោះ",
    "burmese": "နှင့် သို့မဟုတ် သော ၏ ကို မှာ",
}
NOT_FIRST = {
    "thai": "ๆ บาท วัน",
    "japanese": "の は が を に へ と も や って です ます",
    "chinese": "的 了 吗 呢 吧 们",
    "lao": "ໆ ກີບ ວັນ",
    "khmer": "ៗ រៀល ថ្ងៃ",
    "burmese": "များ ကျပ် ရက်",
}
OPENERS = {
    "thai": "แต่ และ ผม ฉัน แม่ เรา ราคา รุ่น ใช้ จะ คู่มือ สาย ปุ่ม กล่อง แสง เสียง สี ของ รอ",
    "japanese": "でも しかし だから それに ただし 残念ながら この その これ それ 私",
    "chinese": "但是 不过 所以 而且 可惜 另外 这 那 我 他 她 你 它",
    "lao": "ແຕ່ ແລະ ຂ້ອຍ ຂ້າພະເຈົ້າ ພວກເຮົາ ລາຄາ",
    "khmer": "ប៉ុន្តែ ហើយ ខ្ញុំ យើង តម្លៃ",
    "burmese": "ဒါပေမယ့် ပြီးတော့ ကျွန်တော် ကျွန်မ ဈေး",
}

END = ".!?。！？．｡।॥؟۔‼⁇⁈⁉…～~♪♫។៕။"
STOPS = "…."
WAVES = "～~♪♫"
OPENING = "([{（［｛【〔〈《「『“‘„‚«‹¿¡〝"
CLOSING = ")]}）］｝】〕〉》」』”’“‘»›〞〟"
PAIRS = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "【": "】", "〔": "〕", "〈": "〉", "《": "》", "「": "」", "『": "』", "“": "”", "„": "“”", "«": "»", "‹": "›"}
_EMOJI = "‼⁉←-⇿⌀-⏿☀-➿⬀-⯿\U0001f000-\U0001faff"
_ENDS = re.compile(f"[{re.escape(END)}]+")
_AFTER = re.compile(f"(?:[{re.escape(CLOSING)}\"]|[{_EMOJI}][︎️‍\U0001f3fb-\U0001f3ff]*)*")
_FACE = re.compile(r"(?<=\s)[:;=][-']?[)(DPpO3]+(?=\s)")
_WIDE = re.compile("[⺀-鿿豈-﫿\U00020000-\U0003ffff]")
_HANGUL = re.compile("[가-힯ᄀ-ᇿ]")
_SPACELESS = {"thai": "฀-๿", "lao": "຀-໿", "khmer": "ក-៓ៗ", "burmese": "က-၉ၐ-႟", "japanese": "぀-ヿ㐀-䶿一-鿿", "chinese": "㐀-䶿一-鿿"}
_ZH_JA = "ぁ-ゖァ-ヺー々㐀-䶿一-鿿"
_SPACES = re.compile(f"(?<=[฀-໿ក-៓ៗက-၉ၐ-႟]) +(?=\\S)|(?<=[{_ZH_JA}])[ \t\u00a0\u3000]+(?=[{_ZH_JA}])")
_RUN_BEFORE, _RUN_AFTER = re.compile("[㐀-䶿一-鿿]{4}$"), re.compile("[㐀-䶿一-鿿]{4}")
_MONTH = re.compile(r"(?:jan|feb|m[äa]r|apr|ma[iy]|jun|jul|aug|se[pt]|okt|oct|nov|de[zc])", re.I)
_TOKEN_END = re.compile(r"[\s(（「『“\"«„]")


@lru_cache(maxsize=1)
def _open() -> frozenset[str]:
    return frozenset(OPEN_ABBREVIATIONS.split())


@lru_cache(maxsize=1)
def _close() -> frozenset[str]:
    return frozenset(CLOSE_ABBREVIATIONS.split())


# ---- words of scripts without spaces ---------------------------------------------------------------------------------


@lru_cache(maxsize=8)
def _dictionary(script: str) -> tuple[frozenset[str], int]:
    words = frozenset(w for table in (FINALS, NOT_LAST, NOT_FIRST, OPENERS) for w in table[script].split())
    return words, max(map(len, words))


def word_lattice(s: str, script: str) -> list[str]:
    """The cheapest path through the lattice of dictionary words; an unknown character costs more than a word, runs of them join."""
    words, longest = _dictionary(script)
    best: list[tuple[float, int, bool]] = [(0.0, 0, True)]
    for z in range(1, len(s) + 1):
        cost, start, known = best[z - 1][0] + 1.0, z - 1, False
        for a in range(max(0, z - longest), z):
            if s[a:z] in words and best[a][0] + 0.9 - 0.05 * (z - a) < cost:
                cost, start, known = best[a][0] + 0.9 - 0.05 * (z - a), a, True
        best.append((cost, start, known))
    out: list[str] = []
    z, unknown = len(s), False
    while z:
        _, a, known = best[z]
        if not known and unknown:
            out[-1] = s[a:z] + out[-1]
        else:
            out.append(s[a:z])
        unknown, z = not known, a
    return out[::-1]


@lru_cache(maxsize=8)
def _run(script: str) -> re.Pattern:
    return re.compile(f"[{_SPACELESS[script]}]+")


def _script_at(c: str, kana: bool) -> str | None:
    """The script without spaces that a character belongs to; ``kana``: whether its paragraph has any."""
    for name in ("thai", "lao", "khmer", "burmese"):
        if _run(name).match(c):
            return name
    if "぀" <= c <= "ヿ":
        return "japanese"
    return ("japanese" if kana else "chinese") if _WIDE.match(c) else None


class _Runs:
    """The words of a text's runs of scripts without spaces: every run is segmented whole, once, when a gap beside it asks."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.breaks = [m.start() for m in re.finditer(r"\n\s*\n", text)]
        self._spans: dict[str, tuple[list[int], list[int]]] = {}
        self._words: dict[tuple[str, str], list[str]] = {}
        self._kana: dict[int, bool] = {}

    def script(self, at: int) -> str | None:
        if not 0 <= at < len(self.text):
            return None
        n = bisect_left(self.breaks, at)
        if n not in self._kana:
            a, z = self.breaks[n - 1] if n else 0, self.breaks[n] if n < len(self.breaks) else len(self.text)
            self._kana[n] = bool(re.compile("[぀-ヿ]").search(self.text, a, z))
        return _script_at(self.text[at], self._kana[n])

    def _at(self, script: str) -> tuple[list[int], list[int]]:
        if script not in self._spans:
            spans = [m.span() for m in _run(script).finditer(self.text)]
            self._spans[script] = [a for a, _ in spans], [z for _, z in spans]
        return self._spans[script]

    def _split(self, script: str, run: str) -> list[str]:
        key = script, run
        if key not in self._words:
            self._words[key] = word_lattice(run, script)
        return self._words[key]

    def before(self, at: int, script: str) -> str:
        """The last word of the run that ends at a place."""
        starts, ends = self._at(script)
        i = bisect_left(ends, at)
        return self._split(script, self.text[starts[i] : at])[-1] if i < len(ends) and ends[i] == at else ""

    def after(self, at: int, script: str) -> str:
        """The first word of the run that begins at a place."""
        starts, ends = self._at(script)
        i = bisect_left(starts, at)
        return self._split(script, self.text[at : ends[i]])[0] if i < len(starts) and starts[i] == at else ""


def _space_costs(runs: _Runs, at: int, after: int, script: str) -> tuple[float, float]:
    """(cost of a boundary, cost of none) at a space in a script without spaces between words: particle and opener add up, either
    decides alone. Chinese has no such space within a sentence, so two longer runs are parted without either word."""
    text, before, behind = runs.text, runs.before(at, script), runs.after(after, script)
    final, opener = before in FINALS[script].split(), behind in OPENERS[script].split()
    against = not final and before in NOT_LAST[script].split() or not opener and behind in NOT_FIRST[script].split()
    bare = script == "chinese" and not final and not opener and bool(_RUN_BEFORE.search(text, max(0, at - 4), at) and _RUN_AFTER.match(text, after))
    return max(0.0, 3.0 - 2.5 * final - 2.0 * (opener or bare) + 1.25 * against), 1.0 + (final or opener or bare)


# ---- pairs -----------------------------------------------------------------------------------------------------------


def inside_pairs(text: str) -> list[tuple[int, int]]:
    """Spans of matched quotations and brackets; an opening mark without its closing one in the paragraph opens nothing."""
    spans, stack = [], []
    straight = -1
    for m in re.finditer(r"\n\s*\n|[\(\)\[\]（）［］【】〔〕〈〉《》「」『』“”„«»‹›\"]", text):
        c, i = m.group(), m.start()
        if c[0] == "\n":
            stack, straight = [], -1
        elif c == '"':
            if straight >= 0:
                spans.append((straight, i))
                straight = -1
            elif i + 1 < len(text) and not text[i + 1].isspace() and not (i and text[i - 1].isdigit()):
                straight = i
        else:
            if stack and c in PAIRS.get(text[stack[-1]], ""):
                spans.append((stack.pop(), i))
            elif c in PAIRS:
                stack.append(i)
            else:
                while stack and c not in PAIRS[text[stack[-1]]] and any(c in PAIRS[text[j]] for j in stack):
                    stack.pop()
                if stack and c in PAIRS[text[stack[-1]]]:
                    spans.append((stack.pop(), i))
    return spans


def _token(text: str, end: int) -> str:
    """What stands before a place without space or opening mark, however long."""
    at = end
    while at and not _TOKEN_END.match(text[at - 1]):
        at -= 1
    return text[at:end]


# ---- terminator lattice ----------------------------------------------------------------------------------------------


def _next(text: str, at: int) -> tuple[int, str]:
    while at < len(text) and text[at].isspace():
        at += 1
    return at, text[at : at + 1]


def _first_letter(text: str, at: int) -> str:
    """The character that shows whether something begins: opening marks are looked through."""
    while at < len(text) and (text[at] in OPENING or text[at] == '"'):
        at += 1
    return text[at : at + 1]


def _readings(text: str, start: int, end: int, stop: int) -> tuple[float, float]:
    """(cost of a boundary, cost of none) after a run of end marks text[start:end] whose sentence would end at stop."""
    marks = text[start:end]
    at, c = _next(text, stop)
    if not c:
        return 0.0, 9.0
    before, gap, newline = text[start - 1 : start], text[stop:at], "\n" in text[stop:at]
    first = _first_letter(text, at)
    cased = first.isupper() or first.islower()
    closed = stop > end and any(x in CLOSING or x == '"' for x in text[end:stop])
    wide = bool(_WIDE.match(before) or re.match("[぀-ヿ]", before))
    if newline:
        if "\n" in gap.replace("\r", "").strip(" \t") and gap.count("\n") > 1:
            return 0.0, 9.0
        if first.islower() and set(marks) <= set(STOPS) and _abbreviation(text, start, end)[0] > 1:
            return 4.0, 1.0
        if not closed:
            open_cost, none = _abbreviation(text, start, end) if marks == "." else (0.0, 3.0)
            token = _token(text, start).lower()
            return (0.5, 2.0) if token in _close() and not first.islower() else (open_cost, none)
    if c in ",;:，；：、)）]—–-" and not newline:
        return 6.0, 0.0
    if closed:
        # After a closing mark the sentence goes on unless a new one clearly begins.
        return (0.5, 2.0) if first.isupper() or newline else (4.0, 0.5)
    if first.islower():
        return 5.0, 0.5
    if set(marks) <= set(WAVES):
        if before.isdigit() and first.isdigit() and not gap:
            return 6.0, 0.0
        return (0.5, 2.0) if wide or _HANGUL.match(before) or not before.isascii() else (4.0, 1.0)
    if set(marks) <= set(STOPS) and len(marks) > 1 or "…" in marks and set(marks) <= set(STOPS):
        return (0.5, 2.0) if cased or not _letters_only(first) else (3.0, 1.0)
    if marks == ".":
        if not gap:
            # Glued: decimals, versions, addresses, or a missing space after a whole word.
            token = _token(text, start)
            part = re.search(r"(?:[^\W\d_]{2,}|\d+)$", token)
            begins = first.isupper() and (text[stop : stop + 1] in OPENING or text[stop + 1 : stop + 2].islower() or text[stop + 1 : stop + 2] in "' ’")
            if begins and part and part.group().lower() not in _open() and not re.match(r"www$|https?:", token):
                return 1.0, 2.0
            return (1.5, 2.0) if first.isupper() and text[stop : stop + 1] in OPENING else (6.0, 0.0)
        cost, none = _abbreviation(text, start, end)
        if before.isdigit() and re.search(r"(?:^|\s)\d{1,2}$", text[max(0, start - 4) : start]) and _MONTH.match(text, at):
            return 4.0, 0.5
        return cost, none
    return 0.0, 3.0


def _letters_only(c: str) -> bool:
    return bool(c) and unicodedata.category(c)[0] in "LM"


def _abbreviation(text: str, start: int, end: int) -> tuple[float, float]:
    """(cost of a boundary, cost of none) by what stands before a full stop, where something that could begin follows."""
    token = _token(text, start).lower().lstrip("¿¡([")
    spaced = re.search(r"(\S{1,3}\.\s?\S{1,3})$", text[max(0, start - 8) : start])
    joined = re.sub(r"\s", "", spaced.group()).lower() if spaced else ""
    part = token.rsplit(".", 1)[-1]  # after a missing space
    if token in _open() or joined in _open() or part in _open() and len(part) > 1:
        return 4.0, 0.5
    coming = re.match(r"\s?([^\W\d_]{1,3})\.", text[end : end + 5])
    if coming and token.isalpha() and (len(token) == 1 or len(token) <= 3 and text[start - len(token) : start].isupper() and coming[1].isupper()):
        return 3.0, 1.0  # the first part of an abbreviation of several
    if token in _close() or joined in _close() or re.fullmatch(r"(?:[^\W\d_]\.)+[^\W\d_]", token):
        _, first = end, _first_letter(text, _next(text, end)[0])
        return (1.0, 2.0) if first.isupper() else (4.0, 0.5)
    if re.fullmatch(r"[^\W\d_]", token) and not _WIDE.match(token):
        return 3.0, 1.0
    if re.fullmatch(r"\d{1,2}", token) and (start - len(token) == 0 or text[start - len(token) - 1] == "\n"):
        return 4.0, 0.5  # the number of a list's entry
    return 0.0, 3.0


# ---- line breaks -----------------------------------------------------------------------------------------------------


def _wrapped(text: str) -> bool:
    """Whether lines end because the next word found no room: then nearly every line plus that word is too long."""
    lines = text.split("\n")
    width = max(map(len, lines))
    breaks = [(a, b) for a, b in zip(lines[:-1], lines[1:], strict=True) if a.strip() and b.strip()]
    if not breaks or width < 20:
        return False
    full = 0
    for a, b in breaks:
        head = b[:1] if _WIDE.match(b[:1]) and _WIDE.match(a[-1:]) else " " + b.split(None, 1)[0]
        full += len(a) + len(head) > width
    loose = sum(1 for a, b in breaks if b.lstrip()[:1].islower() and a.rstrip()[-1:] not in END)
    return full >= 0.8 * len(breaks) and (len(breaks) > 1 or loose > 0)


def _breaks_here(runs: _Runs, at: int, after: int, wrapped: bool, width: int) -> bool:
    """Whether a line break without end mark, white space from at to after, is a boundary."""
    text = runs.text
    if text[at:after].count("\n") > 1:
        return True
    last, first = text[at - 1 : at], text[after : after + 1]
    if last in ",，、;；" or first.islower():
        return False
    script = runs.script(at - 1) or runs.script(after)
    if script and (runs.before(at, script) in NOT_LAST[script].split() or runs.after(after, script) in NOT_FIRST[script].split()):
        return False
    if wrapped:
        line = text[text.rfind("\n", 0, at) + 1 : at]
        head = text[after:].split(None, 1)[0]
        room = 1 if _WIDE.match(first) and _WIDE.match(last) else 1 + len(head)
        return len(line) + room <= width
    return True


# ---- sentences -------------------------------------------------------------------------------------------------------


def boundaries(text: str) -> list[int]:
    """Positions after which a new sentence begins, in order."""
    inner, runs = _merged(inside_pairs(text)), _Runs(text)
    wrapped = "\n" in text and _wrapped(text)
    width = max(map(len, text.split("\n"))) if wrapped else 0
    gaps: dict[int, tuple[float, float]] = {}
    for m in _ENDS.finditer(text):
        stop = _AFTER.match(text, m.end()).end()
        gaps[stop] = _readings(text, m.start(), m.end(), stop)
    for m in _FACE.finditer(text):
        if _first_letter(text, _next(text, m.end())[0]).isupper():
            gaps.setdefault(m.end(), (0.5, 2.0))
    for m in re.finditer(r"[^\S\n]*\n\s*", text):
        if m.start() and m.end() < len(text) and m.start() not in gaps:
            gaps[m.start()] = (0.0, 5.0) if _breaks_here(runs, m.start(), m.end(), wrapped, width) else (5.0, 0.0)
    for m in _SPACES.finditer(text):
        if m.start() not in gaps:
            gaps[m.start()] = _space_costs(runs, m.start(), m.end(), runs.script(m.start() - 1))
    return _cheapest(text, gaps, inner)


def _cheapest(text: str, gaps: dict[int, tuple[float, float]], pairs: list[tuple[int, int]]) -> list[int]:
    """The cheapest path through the lattice of readings. A sentence without any letter or digit is dear."""
    places = [g for g in sorted(gaps) if not _inside(pairs, g)]
    chain: list[tuple[int, int]] = []  # (position, index of the boundary before it)
    live = {-1: 0.0}  # last boundary (index into chain) -> cost
    for g in places:
        end, none = gaps[g]
        nxt: dict[int, float] = {}
        best, best_from = None, -1
        for last, cost in live.items():
            start = chain[last][0] if last >= 0 else 0
            bare = 0.0 if any(c.isalnum() for c in text[start:g]) else 6.0
            if best is None or cost + end + bare < best:
                best, best_from = cost + end + bare, last
            nxt[last] = cost + none
        chain.append((g, best_from))
        nxt[len(chain) - 1] = best
        # A bare sentence's cost is all that a later gap can add, so paths dearer by more than that can't win.
        floor = min(nxt.values())
        live = {k: v for k, v in nxt.items() if v <= floor + 6.0}
    at = min(live, key=live.get)
    out = []
    while at >= 0:
        out.append(chain[at][0])
        at = chain[at][1]
    return out[::-1]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Outermost spans, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if not out or a > out[-1][1]:
            out.append((a, b))
    return out


def _inside(pairs: list[tuple[int, int]], g: int) -> bool:
    i = bisect_left(pairs, (g, -1)) - 1
    return i >= 0 and pairs[i][0] < g <= pairs[i][1]


def sentence_starts(text: str | None) -> list[int]:
    """Positions of the first characters of the sentences."""
    if not text or text.isspace():
        return []
    out, size = [], len(text)
    for b in [0, *boundaries(text)]:
        while b < size and text[b].isspace():
            b += 1
        if b < size and (not out or b > out[-1]):
            out.append(b)
    return out


def _sentence_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, starts, units = [], [], []
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            s = sentence_starts(t)
            for a, z in zip(s, [*s[1:], None][: len(s)], strict=True):
                ids.append(i)
                starts.append(a)
                units.append(t[a:z].rstrip())
        cols = [pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(units, pa.string())]
        yield pa.RecordBatch.from_arrays(cols, names=["id", "start_pos", "sentence"])


def sentences(rows: DataFrame, row_id: str, text: str) -> DataFrame:
    """(row_id, start_pos, sentence): the sentences of every row, in order of start_pos."""
    ship_package(rows.sparkSession)
    named = rows.select(F.col(f"`{row_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    return named.mapInArrow(_sentence_batches, "id long, start_pos int, sentence string").withColumnRenamed("id", row_id)
