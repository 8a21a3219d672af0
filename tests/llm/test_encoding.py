from __future__ import annotations

import numpy as np
import pytest

from reviewflow.llm.encoding import _SIGNS, TOGETHER, CharModel, _count_batches, _disguised, _evidence_batches, _signing, evidence, garbled_fields, restored

TEXTS = [
    "这款台灯的光线很柔和，孩子写作业也不累眼睛。快递比预计早到，客服马上补发了配件。", "颜色选得刚好，老人上手没问题，安装花了几分钟。", "El pequeño cargador está bien hecho, además la guía es corta.",
    "Der Lüfter läuft sanft, aber die Rückgabe war schön einfach. Größe und Qualität passen genau.", "Café Grinder™ Rosé – Ø 12 cm, 5 °C", "小さめのランプは思ったより明るいです。返品の手続きは楽でした。",
    "배송이 생각보다 빨리 왔어요. 조명은 은은하고 조립도 쉬웠어요.", "The white lid wipes clean and the cat adores it, don’t worry.",
]
CLEAN = ["Обычный пульт немного шатается, но дети довольны", "Το φως είναι πολύ καλό και δεν κουράζει", "ça va, déjà vu à l'hôtel", "25 °C ± 2 °C, 3 × 5 cm ¼ »ok«", "Ｆｕｌｌ ｗｉｄｔｈ text", "plain ascii", "龘龘鱻麤 is rare"]


@pytest.fixture(scope="module")
def model():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS * 40)], names=["t"])
    parts = list(_count_batches([batch]))
    return CharModel(*(np.concatenate([p.column(i).to_numpy() for p in parts]) for i in (0, 1)))


@pytest.mark.parametrize(
    ("text", "made_by", "read_as"),
    [(TEXTS[0], "utf-8", "latin-1"), (TEXTS[1], "gbk", "latin-1"), (TEXTS[5], "cp932", "cp1252"), (TEXTS[2], "utf-8", "cp1252"), (TEXTS[3], "utf-8", "cp1251"), (TEXTS[6], "euc_kr", "latin-1")],
)
def test_chain_is_undone(model, text, made_by, read_as):
    raw = text.encode(made_by)
    try:
        broken = raw.decode(read_as)
    except UnicodeDecodeError:
        broken = "".join(bytes([b]).decode(read_as, "ignore") or chr(b) for b in raw)
    chain, gain, fixed = restored(broken, model)
    assert gain > 8 and chain.split("+")[0].startswith(made_by.replace("gbk", "gb18030").replace("euc_kr", "cp949"))
    same = sum(a == b for a, b in zip(fixed, text, strict=False))
    assert same >= 0.8 * len(text)


@pytest.mark.parametrize("text", [*CLEAN, *TEXTS])
def test_correct_text_stays(model, text):
    _, gain, fixed = restored(text, model)
    assert gain < 6 or fixed == text


def test_rows(spark):
    broken = TEXTS[0].encode().decode("latin-1")
    rows = [(i, "s", t, None, "x") for i, t in enumerate(TEXTS * 30)]
    rows += [(1000, "s", broken, "", "x"), (1001, None, broken, broken, "x"), (1002, "s", "lost ��� here", None, "x"), (1003, "s", "", "", "x"), (1004, "s", broken * 300, None, "x"), (1005, "t", None, None, "x")]
    df = spark.createDataFrame(rows, "id long, source string, t string, field string, posterior string")
    got = {(r.id, r.field): r for r in garbled_fields(df, "id", "source", ["t", "field"]).collect()}
    assert set(got) == {(1000, "t"), (1001, "t"), (1001, "field"), (1002, "t"), (1004, "t")}
    assert got[1000, "t"].repaired == TEXTS[0] and got[1002, "t"].chain == "lost"
    assert garbled_fields(df.limit(0), "id", "source", ["t"]).count() == 0


@pytest.fixture(scope="module")
def reviews():
    """Sentences of a small corpus with accents, of which some are garbled by one chain; the correct ones are decoys."""
    words = ["café grinder", "naïve design", "décor light", "½ size", "5 °C inside", "€12 only", "Rosé cup", "it’s quiet"]
    clean = [f"The {a} is near the {b} and works for {n} days" for n in range(40) for a in words for b in ("window", "door", "bed", "desk")]
    return clean


@pytest.mark.parametrize("chain", [("utf-8", "gb18030"), ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp1252", "cp1251"), ("utf-8", "cp1252")])
def test_single_letters_are_found(spark, reviews, chain):
    made_by, read_as = chain
    clean = reviews[:1200]
    broken = []
    for x in reviews[1200:]:
        try:  # only what the chain can carry whole
            broken.append(x.encode(made_by).decode(read_as))
        except UnicodeError:
            pass
    broken = [t for t in broken if not t.isascii()][:60]
    texts = [*clean, *(t for t in broken if t not in reviews)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").selectExpr("id", "'s' source", "t")
    got = {r.id: r for r in garbled_fields(df, "id", "source", ["t"]).collect()}
    want = set(range(len(clean), len(texts)))
    assert len(want & set(got)) >= 0.9 * len(want) and not set(got) - want


def test_decoys_stay(spark, reviews):
    df = spark.createDataFrame(list(enumerate([*reviews, *CLEAN])), "id long, t string").selectExpr("id", "'s' source", "t")
    assert garbled_fields(df, "id", "source", ["t"]).count() == 0


def _garbled() -> list[str]:
    made = [t.encode(a, "ignore").decode(b, "replace") for t in TEXTS for a, b in (("utf-8", "latin-1"), ("gbk", "cp1252"), ("utf-8", "gb18030"), ("cp1252", "mac_roman"), ("cp932", "cp1251"))]
    return [t for t in [*made, *(t.encode().decode("latin-1") for t in made[:8]), "lost ��� here", "Ｆｕｌｌ сafé Ã©", "é", "\n\nÃ©\n", f"{TEXTS[2]} " * 200 + "cafÃ©"] if not t.isascii()]


def test_texts_are_searched_together(model, monkeypatch):
    """Scoring costs by the call, so the calls must not grow with the texts: there were two or more for each text."""
    import pyarrow as pa

    calls = []
    scores = CharModel.scores
    monkeypatch.setattr(CharModel, "scores", lambda *a: calls.append(len(a[1])) or scores(*a))
    text = TEXTS[2].encode().decode("latin-1")
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(["s"] * 100), pa.array([text] * 100)], names=["id", "source", "t"])
    shared = type("Shared", (), {"value": model})
    rows = [r for out in _evidence_batches(shared, ["t"])(iter([batch])) for r in out.to_pylist() if r["id"] is not None]
    assert len(text) * 100 < TOGETHER and len(rows) == 100 and {r["better"] for r in rows} == {TEXTS[2]}
    assert len(calls) < 20


def test_evidence_is_that_of_each_text_alone(model):
    texts = _garbled()
    assert evidence(texts, model) == [evidence([t], model)[0] for t in texts]
    assert evidence(texts[::-1], model) == evidence(texts, model)[::-1] and evidence([], model) == []


def test_signs_have_a_character_that_asks_for_a_look():
    others = "".join(chr(i) for i in range(0x20, 0x30000) if not 0xD800 <= i < 0xE000 and not _signing()[i])
    assert not _SIGNS.search(others) and not _disguised().search(others)
    assert all(any(_signing()[ord(c)] for c in p.search(t).group()) for t in _garbled() for p in (_SIGNS, _disguised()) if p.search(t))
