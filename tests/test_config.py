from __future__ import annotations

import json

import pytest

from reviewflow.conf import load
from reviewflow.conf import values as V


def good_headers() -> dict:
    columns = [{"header": h, "aliases": list(a), "required": h in V.REQUIRED} for h, a in V.ALIASES.items()]
    return {"header_row": 1, "output_columns": columns, "drop_headers": list(V.DROP_HEADERS)}


def good_identities() -> dict:
    platforms = [{"namespace": k, "aliases": x["names"], "user_id_headers": x["accounts"], "display_name_headers": x["display"]} for k, x in V.IDENTITIES.items()]
    return {"schema_version": 2, "algorithm_version": V.ALGORITHM, "platforms": platforms}


def put(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return path


def test_agreed_files_pass(tmp_path):
    h, i = put(tmp_path / "h.json", good_headers()), put(tmp_path / "i.json", good_identities())
    load.agreed("headers", h, h)
    load.agreed("identities", i, i)
    with pytest.raises(load.ConfigError, match="agreed"):
        load.agreed("headers", put(tmp_path / "copy.json", good_headers()), h)


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda c: c | {"header_row": True}, "header_row"),
        (lambda c: c | {"header_row": 0}, "header_row"),
        (lambda c: c | {"more": 1}, "more is unknown"),
        (lambda c: {k: v for k, v in c.items() if k != "drop_headers"}, "drop_headers is missing"),
        (lambda c: c | {"drop_headers": ["a", "a"]}, "twice"),
        (lambda c: c | {"drop_headers": ["a", " "]}, r"drop_headers\[1\]"),
        (lambda c: c | {"output_columns": c["output_columns"] + c["output_columns"][:1]}, "header stands twice"),
        (lambda c: c | {"output_columns": []}, "output_columns"),
        (lambda c: [c], "object"),
    ],
)
def test_invalid_files_are_named(tmp_path, change, message):
    with pytest.raises(load.ConfigError, match=message):
        load.headers(put(tmp_path / "h.json", change(good_headers())))


def test_differences_are_named(tmp_path):
    c = good_identities()
    c["platforms"][0]["aliases"] = ["other"]
    p = put(tmp_path / "i.json", c)
    assert load.identities(p) == [c["platforms"][0]["namespace"]]
    with pytest.raises(load.ConfigError, match="differs"):
        load.agreed("identities", p, p)
    for bad in ("{", tmp_path / "none.json"):
        with pytest.raises(load.ConfigError, match="JSON"):
            load.headers(put(tmp_path / "x.json", bad) if isinstance(bad, str) else bad)


def test_a_stage_refuses_another_configuration(tmp_path):
    from reviewflow import cli

    c = good_headers()
    c["output_columns"][0]["aliases"] = ["other"]
    (tmp_path / "a.csv").write_text("评论,评论时间\n", encoding="utf-8")
    with pytest.raises(load.ConfigError, match="评论日期"):
        cli.main(["standardize", str(tmp_path / "a.csv"), "--output", str(tmp_path / "o.xlsx"), "--config", str(put(tmp_path / "h.json", c))])
