from __future__ import annotations

import base64
import json
from datetime import datetime
from pathlib import Path

import pytest

from reviewflow import cli, keys, naming, pipeline, sinks
from reviewflow.operators.headers import HeaderError
from reviewflow.operators.identity import IdentityError
from reviewflow.sources import csv_exact, tabular, xlsx_xml
from reviewflow.sources.paths import InputError, checked, sheet_title


def put(path: Path, text: str, encoding: str = "utf-8") -> Path:
    path.write_bytes(text.encode(encoding))
    return path


def test_csv_encodings_and_rows():
    assert csv_exact.decoded("时间,内容".encode("gb18030"))[1] == "gb18030"
    assert csv_exact.decoded("时间".encode("utf-16"))[1] == "utf-16"
    assert list(csv_exact.rows(b'\xef\xbb\xbfa,"b\nc"\r\n\r\n,\r\n')) == [["a", "b\nc"], [], ["", ""]]
    with pytest.raises(csv_exact.CsvDecodeError):
        csv_exact.decoded(b"\xff\xff\xff")


def test_xlsx_round_trip(tmp_path):
    p = tmp_path / "x.xlsx"
    xlsx_xml.write(p, [("一 & 二", [["h", None, "=1+1"], [1, 2.5, True]])])
    (title, rows), = list(xlsx_xml.sheets(p.read_bytes()))
    assert title == "一 & 二"
    assert list(rows) == [(["h", None, "=1+1"], ["s", None, "s"]), (["1", "2.5", "True"], ["n", "n", "b"])]


def test_inputs(tmp_path):
    a = put(tmp_path / "a.csv", "x\n")
    assert sheet_title("a[b]*.csv") == "a_b__"
    for bad in ([], [tmp_path], [tmp_path / "no.csv"], [a, a], [put(tmp_path / "o.xls", "x")]):
        with pytest.raises(InputError):
            checked(bad)


def test_merge_order_blank_rows_and_ragged(spark, tmp_path):
    a = put(tmp_path / "a.csv", "province,user,comment\nP1,u1,c1\n , ,\nP2,u2\n")
    b = put(tmp_path / "b.csv", " province ,user,comment\nP3,u3,c3\n", "gb18030")
    out = pipeline.merge(spark, [a, b], add_source_columns=True).orderBy(*pipeline.ORDER).collect()
    assert [(r.province, r.comment, r.source_file) for r in out] == [("P1", "c1", "a.csv"), ("P2", None, "a.csv"), ("P3", "c3", "b.csv")]
    assert pipeline.inventory(spark, [a, b]) == [{"file": str(a), "sheet": "a", "rows": 2}, {"file": str(b), "sheet": "b", "rows": 1}]
    with pytest.raises(HeaderError):
        pipeline.merge(spark, [a, put(tmp_path / "c.csv", "user,province,comment\n1,2,3\n")])


def test_chain_over_the_command_line(spark, tmp_path, monkeypatch):
    secret = base64.b64encode(b"e" * 32).decode()
    env = {keys.variable("project-screenbar-e2e"): secret}
    keys.register(tmp_path / "registry", "Screenbar", env, "project-screenbar-e2e")
    monkeypatch.setenv(*next(iter(env.items())))
    src = put(tmp_path / "in.csv", "rpid,username,content,like_count,timestamp\n1,user1,回复 @某人：这个产品真的非常好用呀,=1+1,1751328000\n2,user2,好,3,2026-07-01\n")
    merged, bare, std, done = (tmp_path / f"{n}.xlsx" for n in ("merged", "bare", "std", "done"))
    assert cli.main(["merge", str(src), "--output", str(merged)]) == 0
    assert cli.main(["strip-replies", str(merged), "--output", str(bare)]) == 0
    project = ["--platform", "bilibili", "--project-name", "Screenbar", "--registry", str(tmp_path / "registry")]
    assert cli.main(["standardize", str(bare), "--output", str(std), "--reference-date", "2026-07-28", *project]) == 0
    assert cli.main(["audit", str(std), "--source", str(bare), "--output", str(tmp_path / "audit.json")]) == 0
    assert cli.main(["clean", str(std), "--output", str(done), "--target-header", "评论内容", "--platform", "bilibili"]) == 0
    text = done.with_suffix(".csv").read_bytes()
    assert text.startswith(b"\xef\xbb\xbf") and b"\r\n" in text
    lines = text.decode("utf-8-sig").splitlines()
    assert len(lines) == 2 and "2025-07-01,这个产品真的非常好用呀" in lines[1] and "=1+1" in lines[1]
    assert "cad6b15fb4291d29dc08a17581aec2fa0726ea09b1786dd1ef5bf95b5b224b45" in lines[1]
    assert "delete_row,总表,3,,评论长度小于 8,好" in done.with_suffix(".deletions.csv").read_text("utf-8-sig")
    with pytest.raises(sinks.OutputError):
        cli.main(["merge", str(src), "--output", str(merged)])
    assert cli.main(["compare", str(std), "--right", str(std), "--output", str(tmp_path / "cmp.json"), "--comment-column", "2"]) == 0
    assert json.loads((tmp_path / "cmp.json").read_text())["only_left"] == 0


def test_guards_and_cleanup(tmp_path):
    a, x, c, mid = (put(tmp_path / n, "x") for n in ("a.csv", "f.xlsx", "f.csv", "mid.xlsx"))
    with pytest.raises(sinks.OutputError):
        sinks.guard([a], [a])
    with pytest.raises(sinks.OutputError):
        sinks.guard([], [x])
    with pytest.raises(sinks.OutputError):
        sinks.guard([], [x], overwrite=True)
    assert sinks.guard([], [x], True, [x]) == [x.resolve()]
    with pytest.raises(sinks.OutputError):
        sinks.clean_up([x], [x, c], [x, c])
    with pytest.raises(sinks.OutputError):
        sinks.clean_up([mid], [x], [x, c])
    assert sinks.clean_up([mid, tmp_path / "no"], [x, c], [x, c])["deleted"] == [str(mid.resolve())] and not mid.exists()
    with pytest.raises(sinks.OutputError), sinks.staged(tmp_path / "never.txt"):
        pass
    x2 = put(tmp_path / "g.xlsx", "x")
    with pytest.raises(sinks.OutputError):
        sinks.refuse_restoring(x2)


def test_keys(tmp_path):
    env = {keys.variable("p-1"): base64.b64encode(b"k" * 32).decode()}
    keys.register(tmp_path, "P", env, "p-1")
    assert keys.load(tmp_path, name="P", environ=env).project_id == "p-1"
    with pytest.raises(IdentityError):
        keys.load(tmp_path, project_id="p-1", environ={keys.variable("p-1"): base64.b64encode(b"z" * 32).decode()})
    with pytest.raises(IdentityError):
        keys.load(tmp_path, environ=env)
    with pytest.raises(IdentityError), keys.registry_lock(tmp_path), keys.registry_lock(tmp_path, 0.1):
        pass


def test_naming():
    now = datetime(2026, 7, 28, 12)
    p = naming.plan([Path("/w/ScreenBar/亚马逊日本/20260701_亚马逊_评论数据.xlsx")], now=now)
    assert p.source == "亚马逊日本评论数据" and p.product == "ScreenBar" and p.profile == "amazon-japan"
    assert p.files["merge"] == "20260728_ScreenBar_亚马逊日本评论数据_合并总表.xlsx"
    assert naming.plan([Path("/w/youtube数据/Shorts/yt-comments_Lamp.csv")], now=now).source == "YouTube Shorts评论数据"
    x = naming.plan([Path("/w/Lamp_Twitter.csv")], now=now)
    assert x.missing == ["x_data_type"] and not x.files
    assert naming.plan([Path("/w/Lamp_Twitter.csv")], x_data_type="评论", now=now).profile == "twitter-comments"
    with pytest.raises(naming.NamingError):
        naming.plan([Path("/w/Lamp_淘宝.csv")], x_data_type="评论", now=now)


@pytest.mark.parametrize(
    ("path", "source", "product"),
    [
        ("/w/ScreenBar/Amazon US/reviews.csv", "亚马逊美国评论数据", "ScreenBar"),
        ("/w/Lamp/京东/20260701_京东_评论数据.xlsx", "京东评论数据", "Lamp"),
        ("/w/x/乐天市场_Desk Light.csv", "乐天市场评论数据", "Desk Light"),
        ("/w/Desk/merged/20260701-120000.csv", None, "Desk"),
        ("/w/淘宝/抖音_Lamp 2.xlsx", "抖音评论数据", "Lamp"),
        ("/w/case-1/ab Project/comments.csv", None, None),
        ("/w/a/reddit-lamps-1abc2-json-primary.csv", "Reddit评论数据", None),
        ("/w/a/小红书_【1】灯a:b.csv", "小红书评论数据", "灯a b"),
    ],
)
def test_names_of_paths(path, source, product):
    p = naming.plan([Path(path)], now=datetime(2026, 7, 28, 12))
    assert (p.source, p.product) == (source, product)


def test_products_from_tables(spark):
    t = spark.createDataFrame([("灯/泡", "2026-01-05 已购：架子"), ("灯/泡", None)], "`产品名` string, `评论日期与产品` string")
    assert naming.product_candidates_from_tables([t]) == ["架子", "灯 泡"]


def test_preprocess(spark, tmp_path):
    a = put(tmp_path / "r1.csv", "レビュータイトル,評価,レビュー本文,レビュー投稿者,レビュー投稿日,注文日,レビュアー属性,参考になった数\n良い,5,本文,購入者さん,7/8/2026,,男性 50代,3人\n")
    b = put(tmp_path / "r2.csv", "レビュー投稿者,評価,投稿日,レビュー本文,レビュータイトル,レビュアー属性,参考になった数\n花子,4,2026-07-09,b,,女性,\n")
    rows = pipeline.preprocess(spark, [a, b], "rakuten").orderBy(*pipeline.ORDER).collect()
    assert [tuple(r)[5:] for r in rows] == [("2026-07-08", "良い\n\n本文", "5", "男性 50代", "3", None), ("2026-07-09", "b", "4", "女性", "", "花子")]
    assert len(tabular.tables(tabular.read_raw(spark, [a]))) == 1


def two_sheets(path: Path, changed: bool = False) -> Path:
    a = [["评论", "评论时间", "Digg Count"], ["灯很好用真的", "2026/07/01 08:00:00", "3"], ["第二条评论内容", "2026/07/02 09:00:00", "x" if changed else "7"]]
    b = [["content", "timestamp", "like_count", "username"], ["hello there lamp", "1751328000", "", "u1"]]
    xlsx_xml.write(path, [("一", a), ("二", b)])
    return path


def test_audit_of_files_with_differing_sheets(spark, tmp_path):
    src, std, report = two_sheets(tmp_path / "in[1] a.xlsx"), tmp_path / "std.xlsx", tmp_path / "audit.json"
    assert cli.main(["standardize", str(src), "--output", str(std), "--reference-date", "2026-07-28"]) == 0
    done = json.loads(std.with_suffix(".summary.json").read_text())
    assert [(s["sheet"], s["rows"]) for s in done["sheets"]] == [("一", 2), ("二", 1)] and done["mappings"][1]["dropped_headers"] == ["username"]
    assert cli.main(["audit", str(std), "--source", str(src), "--output", str(report)]) == 0
    found = json.loads(report.read_text())
    assert [(s["sheet_name"], s["standardized_data_rows"], s["source_data_rows"], s["source_mapping_checked"]) for s in found["sheets"]] == [("一", 2, 2, True), ("二", 1, 1, True)]
    wrong = two_sheets(tmp_path / "wrong.xlsx", changed=True)
    assert cli.main(["audit", str(std), "--source", str(wrong), "--output", str(tmp_path / "b.json")]) == 2
    assert json.loads((tmp_path / "b.json").read_text())["issues"] == [{"code": "mapped_value_mismatch", "sheet_name": "一"}]
    other = tmp_path / "other.xlsx"
    xlsx_xml.write(other, [("二", [["content", "timestamp"]]), ("三", [["x"]])])
    assert cli.main(["audit", str(std), "--source", str(other), "--output", str(tmp_path / "c.json")]) == 2
    codes = {(i["code"], i["sheet_name"]) for i in json.loads((tmp_path / "c.json").read_text())["issues"]}
    assert codes == {("worksheet_name_or_order_mismatch", None), ("source_worksheet_missing", "一"), ("data_row_count_mismatch", "二")}


def test_audit_of_a_csv_with_a_changed_cell(spark, tmp_path):
    src, std = put(tmp_path / "x.csv", "评论,评论时间,Digg Count\n灯很好用真的,2026/07/01 08:00:00,3\n"), tmp_path / "std.csv"
    assert cli.main(["standardize", str(src), "--output", str(std), "--reference-date", "2026-07-28"]) == 0
    std.rename(tmp_path / "x2.csv")
    (tmp_path / "d").mkdir()
    text = (tmp_path / "x2.csv").read_text("utf-8-sig")
    same, changed = put(tmp_path / "d" / "x.csv", text), put(tmp_path / "d" / "y.csv", text.replace("真的", "假的"))
    assert cli.main(["audit", str(same), "--source", str(src), "--output", str(tmp_path / "1.json")]) == 0
    changed.rename(same)
    assert cli.main(["audit", str(same), "--source", str(src), "--output", str(tmp_path / "2.json")]) == 2


def test_comparison_bundle(spark, tmp_path):
    a, b = put(tmp_path / "a.csv", "n,d,评论内容\n1,x,t1\n1,x,t1\n2,y,t2\n"), put(tmp_path / "b.csv", "n,d,评论内容\n1,x,t1\n3,y,t2\n")
    out = tmp_path / "out"
    assert cli.main(["compare", str(a), "--right", str(b), "--output", str(tmp_path / "cmp.json"), "--output-dir", str(out)]) == 0
    found = json.loads((out / "comparison-summary.json").read_text())
    assert (found["only_left"], found["only_right"], found["comments_only_left"], found["comments_only_right"], found["sequence_mismatches"]) == (2, 1, 1, 0, 1)
    rows = list(csv_exact.rows((out / "only-in-left.csv").read_bytes()))
    assert rows[0] == ["source_row", "row_hash", "n", "d", "评论内容"] and [r[0] for r in rows[1:]] == ["2", "4"]
    assert [t for t, _ in xlsx_xml.sheets((out / "comparison-report.xlsx").read_bytes())] == ["Summary", "Only in Left", "Only in Right", "Comment Diff", "Sequence Diff"]


def test_product_from_files(spark, tmp_path, capsys):
    (tmp_path / "merged").mkdir()
    src = put(tmp_path / "merged" / "20260701.csv", "商品名称,评论内容\n灯,a\n灯,b\n")
    assert cli.main(["name", str(src), "--data-source", "京东评论数据"]) == 0
    shown = json.loads(capsys.readouterr().out)
    assert shown["products"] and shown["source"] == "京东评论数据"
