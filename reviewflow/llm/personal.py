"""Personal information inside free text -> typed placeholders, the rest of the text unchanged.

Method: bootstrapped contextual extraction. Seed entities (shapes that prove themselves: addresses of mail and streets, numbers
with the form of a person's number or a telephone, names with a title or an introducing phrase) induce lexical patterns, which
are the words to the left and right of an entity. Patterns and instances form a bipartite graph with counted edges; Spark
scores it iteratively: a pattern is worth the share of its occurrences that are believed instances, an instance is believed
by its best patterns. Patterns of high confidence then discover identifiers that no seed rule knows. Names discovered so induce further
patterns by the words on their other side, which are looked for in all texts and scored like the first, until no new ones come.

An instance of a number is its shape (digits masked), as numbers hardly repeat; an instance of a name is the name.

Patterns are learnt from all seed names. Names stay in Spark: the workers get a filter of names and of their beginnings, of at most
``MOST_BITS`` bits, and what passes it is joined with the whole table of names. Patterns are kept by support and confidence only and
go to the workers. Extraction reads every text whole.

Defined results
* null gives null and no finding; empty texts and texts without any entity stay as they are.
* findings of different kinds don't overlap: an address or mail address wins over a number or name inside it.
* an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from datetime import date
from functools import lru_cache, reduce
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.text import mix
from reviewflow.storage import ship_package, written

KINDS = ("email", "phone", "id_number", "address", "name")
#: Bits of the filter for each of its entries, and bits at most; a fuller filter lets more through, which the join removes.
ENTRY_BITS, MOST_BITS = 16, 1 << 27
#: Characters that are looked up in the filter at once.
CHUNK = 1 << 18
#: A pattern needs so many distinct instances, and so much confidence to extract.
SUPPORT, SURE, SURE_AFTER = 2, 0.6, 0.8
ROUNDS = 4

# Frequent Chinese surnames of one and of two characters.
SURNAMES = (
    "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕苏卢蒋蔡贾丁魏薛叶阎余潘杜戴夏钟汪田任姜范方石姚谭廖邹熊金陆郝孔白崔康毛邱秦江史顾侯邵孟龙万段雷钱汤尹黎易常武乔贺赖龚文"
    "柏简纪霍岳裴祝宁温颜凌莫童安骆卓季詹关苗符喻容"
)
COMPOUND_SURNAMES = "欧阳 诸葛 司徒 慕容 端木 上官 司马 东方 皇甫 尉迟 公孙 令狐 宇文 长孙 夏侯 南宫 轩辕 闻人"
# Frequent Korean surnames.
KOREAN_SURNAMES = "남궁 황보 제갈 사공 선우 독고 서문 동방 김 이 박 최 정 강 조 윤 장 임 한 오 서 신 권 황 안 송 류 전 홍 고 문 양 손 배 백 허 유 남 심 노 하 곽 성 차 주 우 구 민 진 지 엄 채 원 천 방 공 현 함 변 염 여 추 도 소 석 선 설 마 길 연 위 표 명 기 반 라 왕 금 옥 육 인 맹 제 모 탁 국 은 편 용"
# Phrases that introduce or close a name; {} is the name.
NAME_SEEDS = {
    "zh": "{}先生 {}女士 {}小姐 我叫{} 收货人{} 收件人{} 联系人：{} 姓名：{} 请转告{}",
    "ja": "{}様 {}さん {}と申します 宛名：{} 氏名：{} 受取人は{} 担当の{}",
    "ko": "{}님 {}_씨 이름은_{} 담당자_{} 사람은_{}",
    "latin": "mr._{} mrs._{} ms._{} dr._{} my_name_is_{} signed,_{} señora_{} señor_{} me_llamo_{} firmado:_{} frau_{} herr_{} herrn_{} mein_name_ist_{} mme_{} madame_{} monsieur_{} je_m'appelle_{} signé_{} "
    "c/o_{} addressed_to_{} thanks_to_{} ask_for_{} a_nombre_de_{} gracias_a_{} pregunten_por_{} bitte_an_{} geliefert_an_{} gruß,_{} merci_à_{} demandez_{}",
    "cyrillic": "г-н_{} г-жа_{} меня_зовут_{} подпись:_{}",
}

_HAN = "[一-鿿々]"
_CAP = r"(?:[A-ZÀ-ÖØ-Þ][\w'’]*(?:-[A-ZÀ-ÖØ-Þ][\w'’]*)*)"
_CYR = "(?:[А-ЯЁ][а-яё]+(?:-[А-ЯЁ][а-яё]+)?|[А-ЯЁ]{3,})"
SHAPES = {
    "zh": f"(?:{'|'.join(COMPOUND_SURNAMES.split())}){_HAN}{{1,2}}|[{SURNAMES}]{_HAN}{{1,2}}",
    "ja": f"{_HAN}{{1,3}}[ 　]?(?:{_HAN}{{1,3}}|[ぁ-ん]{{2,4}}|[ァ-ヶー]{{2,5}})",
    "ko": f"(?:{'|'.join(KOREAN_SURNAMES.split())})[가-힣]{{1,2}}",
    "latin": rf"(?:[A-ZÀ-Þ]\.|{_CAP})(?: (?:(?:de|del|la|van|von|der|den|da|di|du|le|Van|Von|De|La|VAN|DE|LA|DEL) ){{0,2}}{_CAP}){{1,2}}",
    "cyrillic": f"{_CYR}(?: {_CYR}){{1,2}}",
}
_LEFT_END = {k: re.compile(f"(?:{v})$") for k, v in SHAPES.items()}
_SHAPE = {k: re.compile(v) for k, v in SHAPES.items()}

# ---- a text of the same length in which forms of width and dashes are one ----------------------------------------------


class _Widths(dict):
    """For str.translate, which is slow where a character is missing."""

    def __missing__(self, point: int) -> int:
        self[point] = point
        return point


@lru_cache(maxsize=1)
def _plain_table() -> dict[int, str]:
    out = {i: chr(i - 0xFEE0) for i in range(0xFF01, 0xFF5F)} | {0x3000: " ", 0xA0: " ", 0x202F: " ", 0x2009: " ", 0x2007: " "}
    out |= {ord(c): "-" for c in "‐‑‒–—−－"}
    return _Widths(out)


_WIDTHS = re.compile("[\u00a0\u2007\u2009-\u2015\u202f\u2212\u3000\uff01-\uff5e]")
_SPLIT = re.compile("[\u0300-\u036f\u200b-\u200f\u2060\ufeff\u00ad]")
_HIDDEN = re.compile("[​-‏⁠﻿­]")


def plain(text: str) -> tuple[str, list[int] | None]:
    """The text to search in, and where its characters are in the original (None: at the same places)."""
    if text.isascii():
        return text, None
    s = text.translate(_plain_table()) if _WIDTHS.search(text) else text
    if not _SPLIT.search(s):
        return s, None
    chars, places, i = [], [], 0
    while i < len(s):
        j = i + 1
        while j < len(s) and ("̀" <= s[j] <= "ͯ" or _HIDDEN.match(s[j])):
            j += 1
        cluster = unicodedata.normalize("NFC", _HIDDEN.sub("", s[i:j]))
        chars.append(cluster)
        places += [i] * len(cluster)
        i = j
    return "".join(chars), [*places, len(s)]


# ---- shapes that prove themselves --------------------------------------------------------------------------------------

_EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*\s?(?:@|\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]+(?:(?:\.|\s?[(\[]dot[)\]]\s?)[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", re.I)
#: What an address of mail has in its middle, one of these.
_AT = ("@", "(at)", "[at]", "{at}")
# Addresses, each in two steps: a core that is searched, and what may stand before it.
_ROADS = (
    (
        re.compile(r"(?:大道|街道|路|街|巷|胡同)\s?\d+\s?(?:弄\s?\d+\s?号?|号)(?:院)?(?:\s?\d+\s?(?:栋|幢|号楼|单元|楼))*(?:\s?\d+\s?(?:室|房))?"),
        re.compile(r"(?:[一-鿿]{2,4}?省)?(?:[一-鿿]{2,4}?(?:市|州))?(?:[一-鿿]{2,4}?(?:区|县|镇|乡))?[一-鿿]{1,6}$"),
    ),
    (
        re.compile(r"\d+(?:丁目\s?\d+(?:番地?)?(?:[-の]\d+)*(?:号)?|(?:-\d+){1,3})(?:\s?[一-鿿ァ-ヶー]{1,8}(?:荘|マンション|ハイツ|コーポ|ビル)?\s?\d+(?:号室)?)?"),
        re.compile(r"(?:[一-鿿]{1,4}[都道府県])?(?:[一-鿿ケヶ]{1,5}[市区郡町村])+[一-鿿ァ-ヶ]{1,6}\s?$"),
    ),
    (
        re.compile(r"(?:로|길|대로)\s?(?:\d+번?길\s?)?\d+(?:-\d+)?(?:\s?\d+동)?(?:\s?\d+호)?(?=[가-힣\s,.]|$)"),
        re.compile(r"(?:[가-힣]{1,5}(?:특별시|광역시|시|도)\s)?(?:[가-힣]{1,5}(?:시|군|구|읍|면|울)\s){0,2}[가-힣]{1,5}(?:구|군|시|읍|면|울구)\s[가-힣]{1,8}$"),
    ),
)
_ROAD_CUE = re.compile("^(?:退货|寄到|寄|我住|住在|住|地址|送到|发到|收货)+")
# Words of which a street address in these languages has one.
_ROAD_WORDS = frozenset(
    "street st ave avenue road rd lane ln drive dr boulevard blvd way court ct place pl terrace close crescent square box "
    "calle avda avenida plaza paseo carrer camino c/ straße weg platz allee rue place quai allée chemin impasse cours route "
    "ул улица пр-т проспект пер переулок наб".split()
)
_WORD = re.compile(r"\w+")
_DIGIT = re.compile(r"\d")
# Those that an address may have without a word's edge before or after them.
_ROAD_STEMS = "Calle Avda Avenida Plaza Paseo Carrer Camino C/ ул. улица пр-т проспект пер. переулок наб.".split()
_ROAD_END = re.compile(r"(?:stra(?:ß|ss)e|str\.|weg|platz|gasse|allee|ufer|damm|ring) \d")
_ADDRESSES = re.compile(
    "|".join(
        (
            r"(?:(?:Flat|Apt|Unit|Suite)\.? \d+\w?, )?\d{1,5}[A-Za-z]? (?:[A-Z][\w'’]+ ){1,3}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd|Way|Court|Ct|Place|Pl|Terrace|Close|Crescent|Square)\b\.?(?:, (?:Apt|Flat|Unit|Suite)\.? ?\d+\w?)?",
            r"P\.? ?O\.? Box \d+",
            r"(?:Calle|Avda\.?|Avenida|Plaza|Paseo|Carrer|Camino|C/) (?:de (?:la |los |las )?|del )?(?:[A-ZÁÉÍÓÚÑ]\w+ ?(?:de (?:la |los )?|del )?){1,4},? ?(?:n\.?º ?)?\d{1,4}(?:, ?\d+\.?º ?\w)?",
            r"(?:[A-ZÄÖÜ][\wäöüß]+(?:straße|strasse|str\.|weg|platz|gasse|allee|ufer|damm|ring)|(?:[A-ZÄÖÜ][\wäöüß]+ )(?:Straße|Weg|Platz|Allee)) \d{1,4} ?[a-z]?\b",
            r"\d{1,4}(?: ?(?:bis|ter))?,? (?:rue|avenue|boulevard|place|quai|allée|chemin|impasse|cours|route) (?:de la |de l'|des |du |de |d')?(?:[A-ZÀ-Þ][\w'’-]+ ?){1,4}",
            r"(?:ул\.|улица|пр-т|проспект|пер\.|переулок|наб\.) ?[А-ЯЁ][\w-]+(?: [А-ЯЁ]?[\w-]+)?,? ?(?:д\. ?|дом )?\d+\w?(?:,? ?(?:кв\.|корп\.|стр\.) ?\d+)*",
        )
    )
)


def address_spans(s: str) -> Iterator[tuple[int, int]]:
    for core, lead in _ROADS:
        for m in core.finditer(s):
            before, room = None, 40
            while True:  # as far back as the lead goes
                start = max(0, m.start() - room)
                before = lead.search(s[start : m.start()])
                if start == 0 or before is None or before.start():
                    break
                room *= 2
            if before:
                a = start + before.start()
                cue = _ROAD_CUE.match(s[a : m.start()])
                yield (a + cue.end() if cue and a + cue.end() < m.start() else a), m.end()
    if not _ROAD_WORDS.isdisjoint(_WORD.findall(s.lower())) or _ROAD_END.search(s) or any(x in s for x in _ROAD_STEMS):
        for m in _ADDRESSES.finditer(s):
            yield m.span()


_ENOUGH = re.compile(r"(?:\d[ ()\-.]{0,2}){6}|[A-Z]\d\d[A-Z]\d{5}|[A-Z]{2} ?\d\d ?\d\d ?\d\d")
_NUMBER = re.compile(r"(?<![\w@.+/-])(?:[A-Za-z]{1,2} ?)?[+(]{0,2}\d(?:[\d() -]|\.(?=\d\d)){4,24}(?:\d|\b)(?:[ -]?[A-Za-z](?![A-Za-z]))?|(?<![A-Za-z0-9])[A-Z]\d{2}[A-Z]\d{5}(?!\d)|(?<![A-Za-z])[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-D](?![A-Za-z])", re.A)
_IDS = re.compile(
    r"\d{6} ?(?P<y>(?:18|19|20)\d\d)(?P<m>\d\d)(?P<d>\d\d) ?\d{3}[\dXx]|(?P<kr>\d{6})-[0-9]\d{6}|\d{3}[- ]\d{2}[- ]\d{4}|\d{4} \d{4} \d{4}|\d{8}-?[A-Z]|\d\d \d\d \d{6}|[12347890] \d\d \d\d \d\d \d{3} \d{3}(?: \d\d)?|[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-D]|[A-Z]\d{2}[A-Z]\d{5}"
)
_PHONES = re.compile(
    r"\+\d{1,3}[ -]?(?:\(?\d{1,4}\)?[ -]?){2,5}\d{2,4}|\(\d{3}\) ?\d{3}-\d{4}|1[3-9]\d(?:[ -]?\d{4}){2}|0\d{1,3}-\d{7,8}|0\d{1,3}-\d{3,4}-\d{4}|01\d-\d{3,4}-\d{4}|0\d(?:[ .]\d\d){4}|8 ?\(\d{3}\) ?\d{3}-\d\d-\d\d|\d{3}-\d{3}-\d{4}|[6-9]\d\d \d{3} \d{3}"
)


def _is_id(s: str) -> bool:
    m = _IDS.fullmatch(s)
    if not m:
        return False
    try:
        if m["y"]:
            date(int(m["y"]), int(m["m"]), int(m["d"]))
        elif m["kr"]:
            date(2000, int(m["kr"][2:4]), int(m["kr"][4:6]))
    except ValueError:
        return False
    return True


def number_spans(s: str) -> list[tuple[int, int, str]]:
    """(start, end, seed kind or '') of every number that is long enough for an identifier."""
    out = []
    for m in _NUMBER.finditer(s):
        a, z = m.span()
        while z > a and s[z - 1] in " -.(":
            z -= 1
        raw = s[a:z]
        lead = re.match(r"[A-Za-z]{1,2} ?", raw)
        if lead and not _is_id(raw):
            if raw[lead.end() - 1] != " ":
                continue  # SF0599583 and the like: a code
            a, raw = a + lead.end(), raw[lead.end() :]
        tail = re.search(r"[ -]?[A-Za-z]$", raw)
        if tail and not _is_id(raw):
            if raw[tail.start()] not in " -":
                if not re.fullmatch(r"\d{8}[A-Za-z]|\d{17}[A-Za-z]", raw):
                    continue
            z, raw = z - len(tail.group()), raw[: tail.start()]
        raw = raw.rstrip(" -(")
        z = a + len(raw)
        digits = sum(c.isdigit() for c in raw)
        if digits < 6 or not raw:
            continue
        date_like = re.fullmatch(r"(?:19|20)\d\d[-.](?:0?[1-9]|1[0-2])[-.](?:0?[1-9]|[12]\d|3[01])", raw)
        if date_like or raw.count("-") >= 2 and digits < 9 or s[a - 1 : a] in ("V", "v", "#") or s[z : z + 1] == "%":
            continue
        out.append((a, z, "id_number" if _is_id(raw) else "phone" if _PHONES.fullmatch(raw) and 8 <= digits <= 15 else ""))
    return out


# ---- contexts ----------------------------------------------------------------------------------------------------------

_EAST = "⺀-⿟ぁ-ヿ㐀-鿿가-힯"
_EAST_LEFT = re.compile(f"[{_EAST}]{{2,3}}\\s?[:：]?\\s?$|[{_EAST}]\\s?[:：]\\s?$")
_EAST_RIGHT = re.compile(f"\\s?[{_EAST}]{{2,4}}")
_WORDS_LEFT = re.compile(r"(?:[^\W\d_][\w'’-]* ){0,1}[^\W\d_][\w'’/-]*(?:[:,]|(?<=\b\w{2})\.|(?<=\b\w{3})\.)? ?$|(?:--?|[(])\s?$")
_WORDS_RIGHT = re.compile(r",? (?:[\w'’-]+ ?){1,2}|[)]")


def contexts(s: str, a: int, z: int) -> list[str]:
    """Pattern nodes of a span: the words or characters before it (L) and after it (R); a sentence's end is no context."""
    out = []
    left = s[_words_back(s, a, 3) : a]
    if m := _EAST_LEFT.search(s[max(0, a - 6) : a]) or _WORDS_LEFT.search(left):
        out.append("L" + m.group().lower().replace(" ", "_"))
    if m := _EAST_RIGHT.match(s, z) or _WORDS_RIGHT.match(s, z):
        out.append("R" + m.group().lower().replace(" ", "_"))
    return out


def _words_back(s: str, at: int, n: int) -> int:
    """Where the n-th word before a place begins, however long words are."""
    for _ in range(n):
        at = s.rfind(" ", 0, at)
        if at < 0:
            return 0
    return at + 1


def _mask(s: str) -> str:
    return re.sub(r"[A-Za-z]", "A", re.sub(r"\d", "9", s))


def _scripts(s: str) -> list[str]:
    out = ["latin"] if re.search("[A-ZÀ-Þ]", s) else []
    if re.search("[぀-ヿ]", s):
        out.append("ja")
    elif re.search("[一-鿿]", s):
        out.append("zh")
    if re.search("[가-힯]", s):
        out.append("ko")
    if re.search("[А-Я]", s):
        out.append("cyrillic")
    return out


@lru_cache(maxsize=1)
def _seed_rules() -> dict[str, list[tuple[str, re.Pattern]]]:
    """By script: a literal that must occur (in lower case), and the rule."""
    out: dict[str, list[tuple[str, re.Pattern]]] = {}
    for script, rules in NAME_SEEDS.items():
        for r in rules.split():
            before, after = (plain(x.replace("_", " "))[0] for x in r.split("{}"))
            # Phrases are matched in any letter case, the name is not.
            head = f"(?i:{re.escape(before)})" if before else "(?<![\\w一-鿿])" if script in ("zh", "ja", "ko") else ""
            inner = f"(?<![^\\W_])(?P<x>{SHAPES[script]})" if before and script == "latin" else f"(?P<x>{SHAPES[script]})"
            out.setdefault(script, []).append((before.strip() or after.strip(), re.compile(f"{head}{inner}(?i:{re.escape(after)})")))
    return out


@lru_cache(maxsize=1)
def _seed_words() -> re.Pattern:
    words = {w for rules in _seed_rules().values() for w, _ in rules}
    return re.compile("|".join(map(re.escape, sorted(words, key=len, reverse=True))))


def _seed_names(s: str) -> Iterator[tuple[int, int]]:
    low = s.lower()
    if not _seed_words().search(low):
        return
    for script in _scripts(s):
        for word, rule in _seed_rules()[script]:
            if word in low:
                for m in rule.finditer(s):
                    yield m.span("x")


def _edge_batches(n_fields: int):
    """(kind, pattern, instance, seed, n): edges of all numbers, and seed names with n; added up within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: Counter = Counter()
        for b in batches:
            for col in b.columns[:n_fields]:
                for t in col.to_pylist():
                    if not t:
                        continue
                    s, _ = plain(t)
                    if _ENOUGH.search(s):
                        for a, z, kind in number_spans(s):
                            for p in contexts(s, a, z):
                                edges["number", p, _mask(s[a:z]), kind] += 1
                    for a, z in _seed_names(s):
                        edges["name", "", s[a:z], "name"] += 1
        yield from _counted(edges)

    return run


_EDGES = "kind string, pattern string, instance string, seed string, n long"


def _counted(edges: Counter) -> Iterator[pa.RecordBatch]:
    rows = list(edges.items())
    for i in range(0, len(rows), 20000):
        part = rows[i : i + 20000]
        cols = [pa.array([k[j] for k, _ in part], pa.string()) for j in range(4)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array([n for _, n in part], pa.int64())], names=["kind", "pattern", "instance", "seed", "n"])


def _automaton(words: list[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for w in words:
        a.add_word(w, w)
    a.make_automaton()
    return a


_U = np.uint64
_STEP, _WHOLE = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    return mix(h) & _U(bits - 1)


def _points(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32)


def _filter_batches(bits: int):
    """One filter for each task: a bit for every beginning of every name, and one for every whole name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(bits, dtype=bool)
        for b in batches:
            for name in b.column(0).to_pylist():
                h = np.zeros(1, dtype=_U)
                for c in _points(name):
                    h = mix(h * _STEP + _U(c))
                    out[_places(h, bits)] = True
                out[_places(h ^ _WHOLE, bits)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())], names=["filter"])

    return run


def _name_filter(names: DataFrame) -> tuple[bytes, int]:
    """The filter of all names (instance), and the length of the longest."""
    size = names.agg(F.sum(F.length("instance") + 1).alias("n"), F.max(F.length("instance")).alias("longest")).first()
    bits = min(MOST_BITS, 1 << max(16, (ENTRY_BITS * (size.n or 0) - 1).bit_length()))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in names.select("instance").mapInArrow(_filter_batches(bits), "filter binary").toLocalIterator():
        out |= np.frombuffer(r["filter"], dtype=np.uint8)
    return out.tobytes(), size.longest or 0


def _filtered_spans(s: str, bitmap: np.ndarray, longest: int) -> Iterator[tuple[int, int]]:
    """All spans that the filter lets through, among them every occurrence of every name."""
    points = _points(s)
    at, h = np.arange(len(points)), np.zeros(len(points), dtype=_U)

    def passed(x: np.ndarray) -> np.ndarray:
        i = _places(x, 8 * len(bitmap))
        return bitmap[i >> _U(3)] >> (i & _U(7)).astype(np.uint8) & 1 == 1

    for size in range(1, longest + 1):
        room = at + size <= len(points)
        at, h = at[room], h[room]
        h = mix(h * _STEP + points[at + size - 1].astype(_U))
        live = passed(h)
        at, h = at[live], h[live]
        if not len(at):
            break
        for a in at[passed(h ^ _WHOLE)].tolist():
            yield a, a + size


def _context_batches(names: Broadcast, n_fields: int):
    """Contexts of all spans that may be known names; those that are none go in the join with the names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: Counter = Counter()
        bitmap, longest = np.frombuffer(names.value[0], dtype=np.uint8), names.value[1]

        def add(texts: list[str]) -> None:
            starts = list(accumulate((len(s) + 1 for s in texts), initial=0))
            for a, z in _filtered_spans("\0".join(texts), bitmap, longest):
                i = bisect_right(starts, a) - 1
                s, a, z = texts[i], a - starts[i], z - starts[i]
                if z <= len(s):
                    for p in contexts(s, a, z):
                        edges["name", p, s[a:z], "name"] += 1

        texts, size = [], 0
        for b in batches:
            for col in b.columns[:n_fields]:
                for t in col.to_pylist():
                    if t:
                        texts.append(plain(t)[0])
                        size += len(texts[-1])
                        if size >= CHUNK:
                            add(texts)
                            texts, size = [], 0
        if texts:
            add(texts)
        yield from _counted(edges)

    return run


class Extractor:
    """Finds name-shaped spans at pattern nodes; patterns are literal strings in one automaton."""

    def __init__(self, patterns: list[str]) -> None:
        self.left = {p[1:].replace("_", " ") for p in patterns if p[0] == "L"}
        self.right = {p[1:].replace("_", " ") for p in patterns if p[0] == "R"}
        self.machine = _automaton(sorted(self.left | self.right)) if patterns else None

    def names(self, s: str) -> Iterator[tuple[int, int, str]]:
        if self.machine is None:
            return
        low = s.lower()
        if len(low) != len(s):
            low = s
        for end, w in self.machine.iter(low):
            a, z = end + 1 - len(w), end + 1
            if w in self.left and (a == 0 or not (w[0].isalnum() and s[a - 1].isalnum() and w[0].isascii())):
                for script in _scripts(s[z : z + 12]) or ():
                    m = _SHAPE[_near(script, s)].match(s, z)
                    if m:
                        yield m.start(), m.end(), "L" + w.replace(" ", "_")
            if w in self.right:
                for script in _scripts(s[min(max(0, a - 12), _words_back(s, a, 2)) : a]) or ():
                    # Names of words have up to nine of them; in other scripts a name has at most ten characters.
                    lo = _words_back(s, a, 10) if script in ("latin", "cyrillic") else max(0, a - 12)
                    m = _LEFT_END[_near(script, s)].search(s[lo:a])
                    if m:
                        yield lo + m.start(), a, "R" + w.replace(" ", "_")


def _near(script: str, s: str) -> str:
    return "ja" if script == "zh" and re.search("[぀-ヿ]", s) else script


def _match_batches(patterns: Broadcast, n_fields: int):
    """All name-shaped spans that candidate patterns meet: believed names and others, so that a pattern's precision shows.

    What else stands beside such a span comes as edges of kind ``beside``: patterns that it may induce once it is believed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: Counter = Counter()
        x = Extractor(patterns.value)
        for b in batches:
            for col in b.columns[:n_fields]:
                for t in col.to_pylist():
                    if t:
                        s, _ = plain(t)
                        for a, z, p in x.names(s):
                            edges["name", p, s[a:z], ""] += 1
                            for q in contexts(s, a, z):
                                if q[0] != p[0]:
                                    edges["beside", q, s[a:z], ""] += 1
        yield from _counted(edges)

    return run


def score_graph(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, pattern, confidence, support) from edges (kind, pattern, instance, seed, n), seed '' for instances not yet believed.

    Belief starts with seeds. Each round gives patterns the believed share of their occurrences, and instances that are no
    seeds the mean confidence of their patterns, weighted by occurrences.
    """
    e = written(edges.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed"), F.sum("n").alias("n")), "pii-edges")
    believed = e.withColumn("belief", F.when(F.col("seed") != "", 1.0).otherwise(0.0))
    for _ in range(rounds):
        patterns = believed.groupBy("kind", "pattern").agg((F.sum(F.col("belief") * F.col("n")) / (F.sum("n") + 0.5)).alias("confidence"), F.count("*").alias("support"))
        instances = e.where("seed = ''").join(patterns, ["kind", "pattern"]).groupBy("kind", "instance").agg((F.sum(F.col("confidence") * F.col("n")) / (F.sum("n") + 0.5)).alias("new_belief"))
        both = e.join(instances, ["kind", "instance"], "left").withColumn("belief", F.when(F.col("seed") != "", 1.0).otherwise(F.coalesce("new_belief", F.lit(0.0))))
        believed = written(both.select("kind", "pattern", "instance", "seed", "n", "belief"), "pii-belief")
    return written(patterns, "pii-patterns")


def _number_patterns(edges: DataFrame) -> DataFrame:
    """Numbers are scored for both kinds on the same edges: seeds of the other kind are occurrences that speak against."""
    n = edges.where("kind = 'number'")
    each = [n.withColumn("kind", F.lit(k)).withColumn("seed", F.when(F.col("seed") == k, k).otherwise("")) for k in ("phone", "id_number")]
    other = [x.withColumn("instance", F.concat("instance", F.when(F.col("seed") == "", "").otherwise("*"))) for x in each]
    return score_graph(other[0].unionByName(other[1])).where("kind != ''")


def learnt_patterns(rows: DataFrame, fields: list[str]) -> dict[str, dict[str, float]]:
    """Confident patterns by kind; only patterns and the filter come to the driver."""
    spark = rows.sparkSession
    texts = rows.select(*(F.col(f"`{f}`") for f in fields))
    first = written(texts.mapInArrow(_edge_batches(len(fields)), _EDGES), "pii-seeds")
    names = written(first.where("kind = 'name'").select("instance").distinct(), "pii-names")
    known = spark.sparkContext.broadcast(_name_filter(names))
    seen = written(texts.mapInArrow(_context_batches(known, len(fields)), _EDGES).join(names, "instance", "left_semi"), "pii-contexts")
    support = seen.groupBy("pattern").agg(F.count_distinct("instance").alias("k")).where(f"k >= {SUPPORT}")
    candidates = [r.pattern for r in support.orderBy(F.desc("k"), "pattern").select("pattern").collect()]
    seeds = seen.select("kind", "pattern", "instance", F.lit("name").alias("seed"), F.lit(0).cast("long").alias("n"))
    tried, accepted, scored_names = written(support.select("pattern"), "pii-tried"), names, []
    while candidates:
        every = written(texts.mapInArrow(_match_batches(spark.sparkContext.broadcast(candidates), len(fields)), _EDGES), "pii-met")
        # What earlier rounds accepted counts like a seed for the patterns of this round.
        is_known = accepted.withColumn("known", F.lit("name"))
        met = every.where("kind = 'name'").join(is_known, "instance", "left").select("kind", "pattern", "instance", F.coalesce("known", F.lit("")).alias("seed"), "n")
        scored = score_graph(met if scored_names else met.unionByName(seeds))
        scored_names.append(scored)
        # Names that confident patterns introduce, and what stands on their other side.
        sure = scored.where(f"confidence >= {SURE} AND support >= {SUPPORT}").select("pattern", "confidence")
        believed = met.join(sure, "pattern").groupBy("instance").agg((F.sum(F.col("confidence") * F.col("n")) / F.sum("n")).alias("belief")).where(f"belief >= {SURE}")
        believed = written(believed.select("instance").join(accepted, "instance", "left_anti"), "pii-accepted")
        beside = every.where("kind = 'beside'").join(believed, "instance", "left_semi").groupBy("pattern").agg(F.count_distinct("instance").alias("k")).where(f"k >= {SUPPORT}")
        new = written(beside.join(tried, "pattern", "left_anti").select("pattern"), "pii-induced")
        candidates = [r.pattern for r in new.orderBy("pattern").collect()]
        tried, accepted = tried.unionByName(new), accepted.unionByName(believed)
    # What follows a number is often the next finding; such patterns must be surer and show more shapes.
    numbers = _number_patterns(first).where(f"pattern LIKE 'L%' OR confidence >= {SURE_AFTER} AND support > {SUPPORT}")
    scored = reduce(DataFrame.unionByName, scored_names, numbers).where(f"confidence >= {SURE} AND support >= {SUPPORT}")
    out: dict[str, dict[str, float]] = {"phone": {}, "id_number": {}, "name": {}}
    for r in scored.collect():
        out[r.kind][r.pattern] = r.confidence
    return out


class Finder:
    """Final extraction: seeds, and whatever confident patterns introduce."""

    def __init__(self, patterns: dict[str, dict[str, float]]) -> None:
        self.numbers = {k: patterns.get(k, {}) for k in ("phone", "id_number")}
        self.names = Extractor(sorted(patterns.get("name", {})))

    def find(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, kind) in the original text, in order, without overlap."""
        if not text:
            return []
        s, places = plain(text)
        low = s.lower()
        found = [(m.start(), m.end(), "email") for m in _EMAIL.finditer(s)] if any(x in low for x in _AT) else []
        if _DIGIT.search(s):
            found += [(a, z, "address") for a, z in address_spans(s)]
            if _ENOUGH.search(s):
                for a, z, kind in number_spans(s):
                    if kind := self._number_kind(s, a, z, kind):
                        found.append((a, z, kind))
        found += [(a, z, "name") for a, z in _seed_names(s)]
        found += [(a, z, "name") for a, z, _ in self.names.names(s)]
        out: list[tuple[int, int, str]] = []
        order = {k: i for i, k in enumerate(("email", "address", "id_number", "phone", "name"))}
        taken = bytearray(len(s) + 1)
        for a, z, kind in sorted(found, key=lambda x: (order[x[2]], x[0] - x[1])):
            if not any(taken[a:z]):
                taken[a:z] = b"\1" * (z - a)
                out.append((a, z, kind))
        if places is not None:
            out = [(places[a], places[z], k) for a, z, k in out]
        return sorted(out)

    def _number_kind(self, s: str, a: int, z: int, seed: str) -> str:
        near = contexts(s, a, z)
        best = {k: max((self.numbers[k].get(p, 0.0) for p in near), default=0.0) for k in self.numbers}
        top = max(best, key=best.get)
        if best[top] >= SURE and 7 <= sum(c.isdigit() for c in s[a:z]) <= 18:
            return top  # the words around decide between the kinds
        return seed

    def redacted(self, text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for a, z, kind in self.find(text):
            out += [text[at:a], f"<{kind.upper()}>"]
            at = z
        return "".join(out) + text[at:]


def _found_batches(patterns: Broadcast, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(patterns.value)
        for b in batches:
            ids, names, kinds = [], [], []
            for f, col in zip(fields, b.columns[1:], strict=True):
                for i, t in zip(b.column(0).to_pylist(), col.to_pylist(), strict=True):
                    for kind in sorted({k for _, _, k in finder.find(t)}):
                        ids.append(i)
                        names.append(f)
                        kinds.append(kind)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(kinds, pa.string())], names=["id", "field", "kind"])

    return run


def _redact_batches(patterns: Broadcast, n_fields: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(patterns.value)
        for b in batches:
            cols = [pa.array([finder.redacted(t) for t in c.to_pylist()], pa.string()) for c in b.columns[1 : 1 + n_fields]]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["id", *(f"f{i}" for i in range(n_fields))])

    return run


def _named(rows: DataFrame, row_id: str, fields: list[str]) -> DataFrame:
    ship_package(rows.sparkSession)
    return rows.select(F.col(f"`{row_id}`").cast("long").alias("id"), *(F.col(f"`{f}`").alias(f"f{i}") for i, f in enumerate(fields)))


def personal_kinds(rows: DataFrame, row_id: str, fields: list[str]) -> DataFrame:
    """(row_id, field, kind) of every kind that occurs in a field."""
    named = _named(rows, row_id, fields)
    patterns = rows.sparkSession.sparkContext.broadcast(learnt_patterns(rows, fields))
    return named.mapInArrow(_found_batches(patterns, fields), "id long, field string, kind string").withColumnRenamed("id", row_id)


def redacted_texts(rows: DataFrame, row_id: str, fields: list[str]) -> DataFrame:
    """(row_id, fields...) with every finding replaced by its placeholder."""
    named = _named(rows, row_id, fields)
    patterns = rows.sparkSession.sparkContext.broadcast(learnt_patterns(rows, fields))
    schema = "id long, " + ", ".join(f"f{i} string" for i in range(len(fields)))
    return named.mapInArrow(_redact_batches(patterns, len(fields)), schema).withColumnsRenamed({"id": row_id} | {f"f{i}": f for i, f in enumerate(fields)})
