from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewflow.llm import mixture, personal, sentences, tokens

ref = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference():
    t = ref.Tokenizer.from_file(tokens.DEFAULT_VOCABULARY)
    t.encode_special_tokens = True
    return t


HARD = ["", "a" * 5000, "   " * 300 + "x", "\n\n  a<|endoftext|>b", "the" * 999, "😀👩‍👩‍👧" * 200, "0" * 3000, "你好吗" * 2000, "don't I'LL we've", "é́" * 50, "　 x y"]


def test_ids_equal_the_library(reference):
    e = tokens.encoder(tokens.DEFAULT_VOCABULARY)
    rng = random.Random(1)
    more = ["".join(rng.choice("abehilnorst eé你") for _ in range(rng.randrange(400))) for _ in range(60)]
    for s in HARD + more:
        assert e.ids(s) == reference.encode(s, add_special_tokens=False).ids
        d = tokens.Decoder(e.v)
        assert "".join(d.feed(e.ids(s))) + d.finish() == s


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_round_trip(s):
    e = tokens.encoder(tokens.DEFAULT_VOCABULARY)
    d = tokens.Decoder(e.v)
    assert "".join(d.feed(e.ids(s))) + d.finish() == s


def test_memory_of_the_transducer_is_constant():
    t = tokens.Transducer(tokens.encoder(tokens.DEFAULT_VOCABULARY).v)
    most, n = 0, 0
    for byte in b"ab" * 4000:
        n += len(list(t.feed([byte])))
        most = max(most, len(t.last))
    assert n > 0 and most <= 4 * t.v.lookahead


def test_rows_of_ids(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "hi there", "c"), (3, "hi there", "c")], "d long, text string, ids string")
    got = sorted((r.d, list(r.ids)) for r in tokens.token_ids(df, "d", "text").collect())
    assert got[0] == (1, []) and got[1] == (2, []) and got[2] == got[3]
    assert tokens.token_ids(df.limit(0), "d", "text").count() == 0
    assert {r.d: r.n_tokens for r in tokens.token_counts(df, "d", "text").collect()}[3] == 2


def test_mixture(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("one two three four five six".split()) for _ in range(rng.randrange(5, 60))), "big" if i % 10 else "small") for i in range(2000)]
    docs += [(5000, None, "big"), (5001, "", "small"), (5002, "no source", None)] + [(6000 + i, "the very same text again", "big") for i in range(200)]
    targets = [("even", "big", 0.5, 1), ("even", "small", 0.4, 3), ("even", "absent", 0.1, 9), ("one", "small", 1.0, 2)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    t = spark.createDataFrame(targets, "mixture string, source string, target_share double, max_repeats int")
    size = 20000
    chosen = mixture.mixed_documents(d, t, size).collect()
    assert not {5000, 5001, 5002} & {r.doc_id for r in chosen}
    total = Counter()
    for r in chosen:
        assert r.copies <= {"big": 1, "small": 3}[r.source] if r.mixture == "even" else r.copies <= 2
        total[r.mixture, r.source] += r.copies * r.n_tokens
    report = {(r.mixture, r.source): r for r in mixture.share_report(d, t, size).collect()}
    assert {k: report[k].tokens for k in total} == dict(total)
    assert report["even", "absent"].tokens == 0
    cap = 3 * sum(1 for _ in docs)  # small gives at most three times what it has
    assert 0 < total["even", "small"] <= cap * 60
    assert abs(report["even", "big"].actual_share + report["even", "small"].actual_share - 1) < 1e-9
    again = {(r.mixture, r.doc_id): r.copies for r in mixture.mixed_documents(d, t, size).collect()}
    assert again == {(r.mixture, r.doc_id): r.copies for r in chosen}
    repeated = sum(r.copies for r in chosen if r.doc_id >= 6000 and r.mixture == "even")
    assert repeated < 60  # 200 documents of one text count about as one
    assert mixture.mixed_documents(d.limit(0), t).count() == 0


SPLITS = [
    ("Dr. Smith came at 5 p.m. on Monday. It works!", ["Dr. Smith came at 5 p.m. on Monday.", "It works!"]),
    ('I asked, "Will it last?" and nobody answered. Fine.', ['I asked, "Will it last?" and nobody answered.', "Fine."]),
    ("Wait... what is it for? See www.Abc.example/help now.The next one", ["Wait... what is it for?", "See www.Abc.example/help now.", "The next one"]),
    ("他说：“可以用。真的。”然后就走了。等了4天……终于到了。真的好用吗？！👍好", ["他说：“可以用。真的。”然后就走了。", "等了4天……终于到了。", "真的好用吗？！👍", "好"]),
    ("説明書（全42頁。日本語。）は読みやすいです。重さは32.5キロです。", ["説明書（全42頁。日本語。）は読みやすいです。", "重さは32.5キロです。"]),
    ("ปุ่มกดแข็งไปนิดนะครับ แม่ชอบสีนี้มากค่ะ ราคา 34.50 บาท คุ้มมากครับ", ["ปุ่มกดแข็งไปนิดนะครับ", "แม่ชอบสีนี้มากค่ะ", "ราคา 34.50 บาท คุ้มมากครับ"]),
    ("En EE. UU. usan otro enchufe. ¿Cuánto dura?", ["En EE. UU. usan otro enchufe.", "¿Cuánto dura?"]),
    ("Am 55. Mai kam Nr. 3 an. Kabel usw. liegen bei.", ["Am 55. Mai kam Nr. 3 an.", "Kabel usw. liegen bei."]),
    ("Вес ок. 12.5 кг, т. е. немного. «Работает. Честно.» — написал г-н Зел.", ["Вес ок. 12.5 кг, т. е. немного.", "«Работает. Честно.» — написал г-н Зел."]),
    ('उसने कहा, "ठीक है। सच में।" और चला गया। रु. 40 में ठीक है।', ['उसने कहा, "ठीक है। सच में।" और चला गया।', "रु. 40 में ठीक है।"]),
    ("السعر 58.5 د.ك. فقط لا أكثر. هل يكفي؟", ["السعر 58.5 د.ك. فقط لا أكثر.", "هل يكفي؟"]),
    ("음... 아직 모르겠어요. 정말 좋아요~ 가벼워요", ["음... 아직 모르겠어요.", "정말 좋아요~", "가벼워요"]),
    ("A title\n\nThe first sentence goes on\nto the next line. Second.", ["A title", "The first sentence goes on\nto the next line.", "Second."]),
    ("???", ["???"]), ("word", ["word"]),
]


@pytest.mark.parametrize(("text", "expected"), SPLITS)
def test_sentences(text, expected):
    s = sentences.sentence_starts(text)
    assert [text[a:z].rstrip() for a, z in zip(s, [*s[1:], None], strict=True)] == expected


SPACED = [
    ("ใช้ดีมาก แต่ราคาแพง", ["ใช้ดีมาก", "แต่ราคาแพง"]), ("ราคา 34.50 บาท คุ้มมาก", ["ราคา 34.50 บาท คุ้มมาก"]),
    ("物流很快 包装完好", ["物流很快", "包装完好"]), ("用了三天了 好", ["用了三天了", "好"]), ("好看 但是重", ["好看", "但是重"]), ("我很喜欢和 朋友一起用", ["我很喜欢和 朋友一起用"]), ("联系简 听雪女士来取", ["联系简 听雪女士来取"]),
    ("梱包は丁寧でした　音も静か", ["梱包は丁寧でした", "音も静か"]), ("音が大きい でも安い", ["音が大きい", "でも安い"]), ("雨宮 遥菜様宛てに届きました", ["雨宮 遥菜様宛てに届きました"]),
    ("他说：“很好用了 但是贵”。", ["他说：“很好用了 但是贵”。"]),
]


@pytest.mark.parametrize(("text", "expected"), SPACED)
def test_spaces_in_scripts_without_spaces(text, expected):
    s = sentences.sentence_starts(text)
    assert [text[a:z].rstrip() for a, z in zip(s, [*s[1:], None], strict=True)] == expected


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab A.!?。…\n\"“”（）《 1了です", max_size=60))
def test_sentences_of_any_text(s):
    starts = sentences.sentence_starts(s)
    assert starts == sorted(set(starts)) and all(not s[i].isspace() for i in starts)
    assert bool(starts) == bool(s.strip())


def test_sentence_rows(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, " \n", 0), (4, "Good lamp. Nice lid.", 0), (5, "word " * 50000 + ". End. " * 3000, 0)], "d long, text string, start_pos int")
    got = Counter(r.d for r in sentences.sentences(df, "d", "text").collect())
    assert set(got) == {4, 5} and got[4] == 2
    assert sentences.sentences(df.limit(0), "d", "text").count() == 0


PERSONAL = [
    ("邮箱abc.de@mail.example.org，谢谢", {"email"}), ("write to a-b+c (at) x.example now", {"email"}), ("手机号：139 0000 2070", {"phone"}), ("call +1 303 555 0102", {"phone"}),
    ("身份证994576 20041126 0191", {"id_number"}), ("SSN 956 84 4185", {"id_number"}), ("주민번호 500209-9618250", {"id_number"}), ("DNI 00420152B", {"id_number"}),
    ("寄到鹿鸣县望潮大道262号", {"address"}), ("I live at P.O. Box 210, Wexbury", {"address"}), ("住所は水無瀬県桜淵市朝霧町17丁目121-400です", {"address"}), ("88 rue du Vieux Lavoir", {"address"}), ("vivo en Calle Santa Brisa 207", {"address"}),
    ("请转告简听雪女士", {"name"}), ("Mr. Thaddeus Dunmarrow handled it", {"name"}), ("雨宮 遥菜様宛てに届きました", {"name"}), ("황보가온 씨에게 전해 주세요", {"name"}),
    ("@kibimep 你看看", set()), ("快递单SF0599583", set()), ("订单号5201314", set()), ("2024-05-01到的", set()), ("Version 2.31.4 for 39.99", set()), ("serial 5873078X", set()), ("no. 1234567", set()), (None, set()), ("", set()),
]


@pytest.mark.parametrize(("text", "kinds"), PERSONAL)
def test_seeds(text, kinds):
    assert {k for _, _, k in personal.Finder({}).find(text)} == kinds


GUARDED = [
    ("(42 Oak Street)", "address"), ("42 Oak Street!", "address"), ("at 42 Oak Road; thanks", "address"), ("(C/ Mayor 5)", "address"), ("«пр-т Мира 5»", "address"), ("улицаМира 5", "address"),
    ("P.O. Box 210", "address"), ("“12 rue du Lac”", "address"), ("(Neue Straße 5)", "address"), ("JO(AT)X.COM", "email"), ("jo[At]x.com", "email"),
]


@pytest.mark.parametrize(("text", "kind"), GUARDED)
def test_prefilters_let_through_what_the_patterns_match(text, kind):
    assert kind in {k for _, _, k in personal.Finder({}).find(text)}


def test_redaction_keeps_the_rest():
    f = personal.Finder({})
    assert f.redacted("手机号：１３９－００００－２０７０，谢谢") == "手机号：<PHONE>，谢谢"
    assert f.redacted("mail a​b@x.example ok") == "mail <EMAIL> ok"
    assert f.redacted(None) is None


def test_patterns_discover_what_no_seed_knows(spark):
    names = ["简听雪", "柏念安", "裴云舟", "霍若溪", "岳知远", "祝清禾"]
    rows = [f"请转告{n}女士。" for n in names] + [f"开票写{n}，谢谢。" for n in names] + ["开票写沈语棠，好的。"] + [f"call me on +1 303 555 010{i}. fine" for i in range(5)] + ["call me on 6175550161. fine", "lot 6175550161 fine"]
    rows += ["SF0599583", None, "", "x" * 100000]
    df = spark.createDataFrame([(i, t, None, "z") for i, t in enumerate(rows)], "id long, a string, b string, kind string")
    got = {(r.id, r.kind) for r in personal.personal_kinds(df, "id", ["a", "b"]).collect()}
    assert (12, "name") in got, "a frame learnt from known names"
    assert (18, "phone") in got and (19, "phone") not in got
    out = {r.id: r.a for r in personal.redacted_texts(df, "id", ["a"]).collect()}
    assert out[12] == "开票写<NAME>，好的。" and out[18] == "call me on <PHONE>. fine"
    assert personal.personal_kinds(df.limit(0), "id", ["a"]).count() == 0


def test_patterns_are_learnt_from_all_names(spark):
    letters = "abcdefghijklmnopqrst"
    many = [f"Q{a}{b}{c} W{d}e" for a in letters for b in letters for c in letters for d in letters[:3]]
    rows = [f"ask Mr. {n}." for n in many for _ in (0, 1)]
    assert len(set(many)) > 20_000
    rows += [f"请转告{n}女士。" for n in ("简听雪", "柏念安", "裴云舟")] + [f"开票写{n}，谢谢。" for n in ("简听雪", "柏念安", "裴云舟")] + ["开票写沈语棠，好的。"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id long, a string")
    assert "L开票写" in personal.learnt_patterns(df, ["a"])["name"]
    assert {(r.id, r.kind) for r in personal.personal_kinds(df, "id", ["a"]).collect()} >= {(len(rows) - 1, "name")}


def test_the_name_filter_misses_no_occurrence(spark):
    rng = random.Random(4)
    names = ["".join(rng.choice("AB 李听") for _ in range(rng.randrange(2, 7))) for _ in range(40)]
    bitmap, longest = personal._name_filter(spark.createDataFrame([(n,) for n in names], "instance string"))
    s = "".join(rng.choice("AB 李听\0") for _ in range(3000))
    got = set(personal._filtered_spans(s, personal.np.frombuffer(bitmap, "uint8"), longest))
    want = {(i, i + len(n)) for n in names for i in range(len(s)) if s.startswith(n, i)}
    assert want <= got and {(a, z) for a, z in got if s[a:z] in names} == want
    assert personal._name_filter(spark.createDataFrame([], "instance string"))[1] == 0


@pytest.mark.parametrize(
    ("text", "starts"),
    [
        ("ខ្ញុំចូលចិត្ត។ តម្លៃល្អ។", [0, 15]),
        ("ကောင်းပါတယ် ကျွန်တော်ဝယ်မယ်", [0, 12]),
        ("ดี" * 40 + "ครับ แต่ราคาแพง", [0, 85]),  # the particle ends a run far longer than any word
        ("好" * 60 + "了 但是" + "贵" * 40, [0, 62]),
    ],
)
def test_runs_are_segmented_whole(text, starts):
    assert sentences.sentence_starts(text) == starts


def test_a_pattern_of_the_second_round_finds_a_name(spark):
    known = ["Orla Venn", "Tibor Hask", "Mina Quill", "Jory Pell"]
    later = ["Sela Drum", "Pavo Lint", "Edda Moss", "Kito Brand"]
    texts = [f"My name is {n}. It works." for n in known] + [f"It was handled by {n}." for n in known] * 2
    texts += [f"It was handled by {n} at depot nine." for n in later] * 2  # no seed rule knows these names
    texts += ["we asked Wren Sato at depot nine.", "the lamp stands at the wall.", "Great Lamp works."]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    patterns = personal.learnt_patterns(df, ["t"])["name"]
    assert any(p.startswith("Lhandled_by") or p.startswith("Lby") for p in patterns) and any(p.startswith("R") and "depot" in p for p in patterns)
    got = {r.id for r in personal.personal_kinds(df, "id", ["t"]).collect() if r.kind == "name"}
    assert got == set(range(len(texts) - 2))
