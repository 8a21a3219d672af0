"""SQL counterparts, for DuckDB, of the catalog's queries. Written on their own, not generated from the Spark expressions."""

from __future__ import annotations

from reviewflow.conf import values as V

_S = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_S}+|{_S}+$', '', 'g')"


def _nonblank(c: str) -> str:
    return f"nullif({_strip(c)}, '')"


def _has(c: str, p: str, flags: str = "") -> str:
    return f"regexp_matches({c}, {_q(p)}{', ' + _q(flags) if flags else ''})"


def _digits(c: str) -> str:
    return f"translate({c}, '０１２３４５６７８９', '0123456789')"


_TEXT = f"""t AS (SELECT *, coalesce({_strip('"评论内容"')}, '') AS c FROM thread_comments)"""
_SCRIPT = f"""CASE WHEN lower(c) IN ('http://', 'https://') THEN 'neutral' WHEN {_has('c', '[\\x{3040}-\\x{30ff}]')} THEN 'japanese'
 WHEN {_has('c', '[\\x{ac00}-\\x{d7af}\\x{1100}-\\x{11ff}]')} THEN 'korean' WHEN {_has('c', '[\\x{e00}-\\x{e7f}]')} THEN 'thai'
 WHEN {_has('c', '[\\x{900}-\\x{97f}]')} THEN 'hindi' WHEN {_has('c', '[\\x{4e00}-\\x{9fff}]')} THEN 'chinese'
 WHEN {_has('c', '\\p{L}')} AND NOT {_has(f"regexp_replace(c, '\\p{{Latin}}', '', 'g')", '\\p{L}')} THEN 'latin' ELSE 'neutral' END"""
_WORDS = f"""CASE WHEN c <> '' AND NOT {_has('c', '[\\x{4e00}-\\x{9fff}]')} AND ({_has('c', '[A-Za-zÀ-ÖØ-öø-ÿĀ-ž]')} OR {_has('c', _S)})
 THEN len(regexp_extract_all(c, '[\\p{{L}}\\p{{N}}\\p{{M}}]+')) END"""
_LENGTH = f"""CASE WHEN script = 'chinese' THEN CASE WHEN length(c) < 8 THEN '评论长度小于 8' END
 WHEN {_has('c', '^[0-9０-９]+$')} THEN CASE WHEN length(c) < 8 THEN '评论长度小于 8' END
 WHEN words IS NOT NULL THEN CASE WHEN words <= 2 THEN '非中文评论词数小于等于 2' END
 WHEN length(c) <= 4 THEN '非中文无空格短文本长度小于等于 4' END"""
_BASE = f"WITH {_TEXT}, b AS (SELECT *, {_SCRIPT} AS script, {_WORDS} AS words FROM t)"
_CLEAN_WORDS = ("包装盒", "manual", "フィルター")
_CLEAN = "CASE " + " ".join(f"WHEN contains(c, {_q(w)}) THEN {_q('评论包含清理词: ' + w)}" for w in _CLEAN_WORDS) + " END"


def _group(term: str) -> str:
    import re

    if term in V.TERM_SCRIPTS:
        return V.TERM_SCRIPTS[term]
    if term in ("http://", "https://"):
        return "neutral"
    for name, chars in (("japanese", "぀-ヿ"), ("korean", "가-힯ᄀ-ᇿ"), ("thai", "฀-๿"), ("hindi", "ऀ-ॿ"), ("chinese", "一-鿿")):
        if re.search(f"[{chars}]", term):
            return name
    return "latin" if any(c.isalpha() for c in term) else "neutral"


def _term_case() -> str:
    out = []
    for any_case, terms in ((False, V.TERMS_EXACT), (True, V.TERMS_ANY_CASE)):
        for t in terms:
            g = _group(t)
            scope = "" if g == "neutral" else f"script = {_q(g)} AND "
            if g == "latin":
                import re

                edge = r"[^\p{L}\p{N}\p{M}_]"
                p = (f"(^|{edge})" if t[0].isalnum() else "") + re.escape(t) + (f"($|{edge})" if t[-1].isalnum() else "")
                out.append(f"WHEN {scope}{_has('c', p, 'i' if any_case else '')} THEN {_q(t)}")
            else:
                out.append(f"WHEN {scope}contains({'lower(c)' if any_case else 'c'}, {_q(t.casefold() if any_case else t)}) THEN {_q(t)}")
    return "CASE " + "\n ".join(out) + " END"


_RANDOM = f"""(NOT {_has('c', '[\\x{4e00}-\\x{9fff}]')} AND len(list_filter(regexp_extract_all(c, '[A-Za-z0-9]+'), lambda x:
 regexp_matches(x, '^[0-9]{{9,}}$') OR (regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Za-z]') AND length(x) >= 10)
 OR (regexp_matches(x, '^[A-Za-z]{{10,}}$') AND (length(regexp_replace(x, '[^aeiouAEIOU]', '', 'g')) <= 0.2 * length(x) OR regexp_matches(x, '[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z]{{5,}}'))))) > 0)"""
_REASON = f"""coalesce({_LENGTH}, CASE WHEN c IN ({', '.join(map(_q, V.PLACEHOLDERS))}) THEN '评论等于占位文案' END, {_CLEAN},
 '评论包含固定删除词: ' || ({_term_case()}), CASE WHEN {_RANDOM} THEN '评论为无中文随机英文/数字堆砌' END)"""
_REASON_PLAIN = _REASON.replace(f" {_CLEAN},", "")


def _rank(c: str) -> str:
    t = _digits(_strip(c))
    return f"""coalesce(CASE WHEN regexp_matches({t}, '^[+-]?[0-9]+(\\.[0-9]+)?$') THEN try_cast({t} AS DECIMAL(38,6)) END, 0)"""


_LIKES = _rank('"点赞数"')
_DUP = "同一工作表内重复评论（保留点赞数最高，点赞相同保留最后一条）"
_MARKED = f"""{_BASE}, r AS (SELECT *, {_REASON_PLAIN} AS rule, {_LIKES} AS likes FROM b),
 m AS (SELECT *, coalesce(rule, CASE WHEN row_number() OVER (PARTITION BY file_id, sheet, c, rule IS NULL ORDER BY likes DESC, row_number DESC, comment_id DESC) > 1 THEN '{_DUP}' END) AS reason FROM r)"""


def _cells(source: str, order: str) -> str:
    parts = " UNION ALL ".join(f"""SELECT file_id, sheet, {order}, {i} AS i, '{c}' AS h, {_strip(f'"{c}"')} AS v FROM {source}""" for i, c in enumerate(("一级评论", "二级评论", "三级评论")))
    desc = ", ".join(f"{o.strip()} DESC" for o in order.split(","))
    return f"""x AS ({parts}), y AS (SELECT *, length(v) < 6 AS short FROM x WHERE v <> ''),
 z AS (SELECT *, CASE WHEN short THEN '子评论长度小于 6: ' || h WHEN row_number() OVER (PARTITION BY file_id, sheet, v, short ORDER BY {desc}, i DESC) > 1 THEN '同一工作表内重复子评论: ' || h END AS reason FROM y)"""


_UNIX = rf"""CASE WHEN regexp_matches(s, '^[+-]?[0-9]+(\.[0-9]+)?$') AND abs(try_cast(s AS DOUBLE)) < 2.5e14
 THEN CASE WHEN abs(try_cast(s AS DOUBLE)) >= 1e10 THEN try_cast(s AS DOUBLE) / 1000 ELSE try_cast(s AS DOUBLE) END END"""
_DAY = "strftime(TIMESTAMP '1970-01-01 08:00:00' + to_microseconds(CAST(floor(u * 1000000) AS BIGINT)), '%Y-%m-%d')"
_EDITED = f"regexp_replace({_strip('\"评论日期\"')}, '(?i)({_S}+\\(edited\\)|{_S}*（修改过）){_S}*$', '')"
_NUMERAL = "CASE {x} " + " ".join(
    f"WHEN '{k}' THEN {v}"
    for k, v in ({c: i + 1 for i, c in enumerate("一二三四五六七八九")} | {"两": 2, "十": 10} | {f"十{c}": 11 + i for i, c in enumerate("一二三四五六七八九")}).items()
) + " ELSE try_cast({x} AS INTEGER) END"


def _ago(units: str) -> str:
    return _NUMERAL.format(x=f"regexp_extract(n, '(?i)^([0-9]+|[一二两三四五六七八九十]+) *({units})$', 1)")


_REF = "DATE '2026-07-28'"
_RELATIVE = f"""CASE WHEN n IN ('今天', '今日') OR lower(n) = 'today' THEN strftime({_REF}, '%Y-%m-%d') WHEN n = '昨天' OR lower(n) = 'yesterday' THEN strftime({_REF} - 1, '%Y-%m-%d')
 WHEN n = '前天' THEN strftime({_REF} - 2, '%Y-%m-%d')
 WHEN {_ago('年 *前|years? +ago|yrs? +ago')} IS NOT NULL THEN CAST(2026 - {_ago('年 *前|years? +ago|yrs? +ago')} AS VARCHAR)
 WHEN {_ago('[个個]?月 *前|months? +ago|mos? +ago')} IS NOT NULL THEN strftime({_REF} - to_months({_ago('[个個]?月 *前|months? +ago|mos? +ago')}), '%Y-%m')
 WHEN {_ago('周 *前|星期 *前|weeks? +ago|wks? +ago')} IS NOT NULL THEN strftime({_REF} - to_days(7 * {_ago('周 *前|星期 *前|weeks? +ago|wks? +ago')}), '%Y-%m-%d')
 WHEN {_ago('天 *前|日 *前|days? +ago')} IS NOT NULL THEN strftime({_REF} - to_days({_ago('天 *前|日 *前|days? +ago')}), '%Y-%m-%d') END"""


def _cal(c: str, p: str) -> str:
    part = lambda i: f"regexp_extract({c}, '{p}', {i})"
    return f"strftime(try_cast({part(1)} || '-' || lpad({part(2)}, 2, '0') || '-' || lpad({part(3)}, 2, '0') AS DATE), '%Y-%m-%d')"


_CLOCK = "([01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]"
_ISO = r"([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]{1,6})?)?"
_ZONED = rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ]{_ISO}(Z|[+-]([01][0-9]|2[0-3]):[0-5][0-9])$"
_AWARE = f"""CASE WHEN regexp_matches(e, '{_ZONED}') THEN strftime(try_cast(substr(e, 1, 10) || ' ' || regexp_extract(e, '^.{{11}}({_ISO})', 1) AS TIMESTAMP)
 - CASE WHEN e LIKE '%Z' THEN INTERVAL 0 MINUTE ELSE to_minutes((CASE WHEN substr(e, length(e) - 5, 1) = '-' THEN -1 ELSE 1 END) * (CAST(substr(e, length(e) - 4, 2) AS INTEGER) * 60 + CAST(substr(e, length(e) - 1, 2) AS INTEGER))) END
 + INTERVAL 8 HOUR, '%Y-%m-%d') END"""
_PLATFORM_DATE = f"""CASE WHEN regexp_matches(s, '^[0-9]{{8}}$') THEN coalesce({_cal('s', '^([0-9]{4})([0-9]{2})([0-9]{2})$')}, raw) WHEN u IS NOT NULL THEN {_DAY} WHEN s = '' THEN NULL
 ELSE coalesce({_RELATIVE}, {_AWARE}, {_cal('e', f'^([0-9]{{4}})-([0-9]{{2}})-([0-9]{{2}})(?:[T ]{_ISO})?$')}, {_cal('e', f'^([0-9]{{4}})-([0-9]{{1,2}})-([0-9]{{1,2}})(?: +{_CLOCK})?$')},
 {_cal('e', f'^([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}})(?: +{_CLOCK})?$')}, {_cal('e', '^([0-9]{4})年([0-9]{1,2})月([0-9]{1,2})日$')}, raw) END"""


def _dated(source: str, cols: str) -> str:
    return f"""d0 AS (SELECT {cols}, "评论日期" AS raw, {_strip('"评论日期"')} AS s, {_EDITED} AS e FROM {source}),
 d AS (SELECT *, {_UNIX} AS u, regexp_replace(e, '{_S}+', ' ', 'g') AS n FROM d0)"""


_RATING = rf"(?i)^([0-9]+(?:\.[0-9]+)?)(?:{_S}+out{_S}+of{_S}+5{_S}+stars?|{_S}*颗星，最多{_S}*5{_S}*颗星)?$"
_HELPFUL = rf"(?i)^([0-9]+)(?:{_S}+people?{_S}+found{_S}+this{_S}+helpful|{_S}*个人发现此评论有用)?$"


def _likes_text(c: str) -> str:
    t = _digits(_strip(c))
    x = f"regexp_extract({t}, '{_HELPFUL}', 1)"
    return f"""CASE WHEN {c} IS NULL OR {t} = '' THEN '0' WHEN regexp_matches({t}, '(?i)^one{_S}+person{_S}+found{_S}+this{_S}+helpful$') THEN '1'
 WHEN {x} <> '' THEN coalesce(nullif(ltrim({x}, '0'), ''), '0') ELSE {c} END"""


def _nonblank_join(sep: str, *cols: str) -> str:
    return f"nullif(concat_ws({sep}, {', '.join(map(_nonblank, cols))}), '')"


_J = "json_extract_string(payload, '$.\"{}\"')"
_SPLIT = f"^{_S}*([0-9]{{4}}年[0-9]{{1,2}}月[0-9]{{1,2}}日|[0-9]{{4}}[/-][0-9]{{1,2}}[/-][0-9]{{1,2}}){_S}*(?:(?:已购|已购买)[:：])?{_S}*([^\\n]*)$"
_KEY = b"k" * 32


def _hmac(value: str, platform: str, display: bool) -> str:
    """HMAC by two nested digests; the key is public and only for this check."""
    frame = lambda s: len(s.encode()).to_bytes(4, "big") + s.encode()
    head = b"".join(map(frame, [V.ALGORITHM, "project-screenbar", "1", platform, *(["display_name"] if display else [])]))
    pad = lambda b: "".join(f"\\x{x ^ b:02X}" for x in _KEY.ljust(64, b"\0"))
    blob = lambda raw: "".join(f"\\x{x:02X}" for x in raw)
    inner = f"sha256('{pad(0x36)}{blob(head)}'::BLOB || unhex(lpad(printf('%x', strlen({value})), 8, '0')) || encode({value}))"
    return f"sha256('{pad(0x5C)}'::BLOB || unhex({inner}))"


_STD = f"""{_dated('thread_comments', '*')}, std AS (SELECT comment_id,
 CASE WHEN regexp_matches(s, '^[+-]?[0-9]+(\\.[0-9]+)?$') OR regexp_matches({_digits('raw')}, '[0-9]{{1,2}}:[0-9]{{1,2}}') THEN {_PLATFORM_DATE} ELSE raw END AS day,
 "评论内容", {_likes_text('"点赞数"')} AS likes, "子评论数/追评数", "一级评论", "二级评论", "三级评论", file_id, sheet, row_number FROM d)"""



def _unequal(a: str, b: str) -> str:
    """Blank equals blank, numbers are equal by value, anything else by text."""
    num = "'^[+-]?[0-9]+(\\.[0-9]+)?$'"
    value = f"CASE WHEN regexp_matches({a}, {num}) AND regexp_matches({b}, {num}) THEN CAST({a} AS DECIMAL(38, 10)) <> CAST({b} AS DECIMAL(38, 10)) ELSE {a} IS DISTINCT FROM {b} END"
    return f"CASE WHEN {_nonblank(a)} IS NULL THEN {_nonblank(b)} IS NOT NULL ELSE {value} END"


_TREE = "SELECT o_orderkey AS id, CASE WHEN o_orderkey > 1 THEN o_orderkey // 2 END AS parent FROM orders"
_FLAT = f"""WITH RECURSIVE n AS ({_TREE}), w AS (
 SELECT id AS node, id AS root, 0 AS level FROM n WHERE NOT EXISTS (SELECT 1 FROM n p WHERE p.id = n.parent)
 UNION ALL SELECT n.id, w.root, w.level + 1 FROM n JOIN w ON n.parent = w.node)"""

ORACLES = {
    "script_group": f"WITH {_TEXT} SELECT comment_id, {_SCRIPT} AS script FROM t",
    "word_count": f"WITH {_TEXT} SELECT comment_id, {_WORDS} AS words FROM t",
    "delete_length": f"{_BASE} SELECT comment_id, {_LENGTH} AS reason FROM b",
    "delete_placeholder": f"""WITH t AS (SELECT comment_id, 'own' AS kind, "评论内容" AS text FROM thread_comments
 UNION ALL SELECT comment_id, 'placed', ' ' || list_extract([{', '.join(map(_q, V.PLACEHOLDERS))}], CAST(comment_id % {len(V.PLACEHOLDERS)} AS INTEGER) + 1) || chr(12288) FROM thread_comments)
 SELECT comment_id, kind, '评论等于占位文案' AS reason FROM t WHERE {_strip('text')} IN ({', '.join(map(_q, V.PLACEHOLDERS))})""",
    "delete_clean_word": f"WITH {_TEXT} SELECT comment_id, {_CLEAN} AS reason FROM t WHERE {_CLEAN} IS NOT NULL",
    "delete_fixed_terms": f"""WITH t AS (SELECT comment_id, coalesce({_strip('"评论内容"')}, '') || ' ' || list_extract([{', '.join(map(_q, (*V.TERMS_EXACT, *V.TERMS_ANY_CASE)))}], CAST(comment_id % {len(V.TERMS_EXACT) + len(V.TERMS_ANY_CASE)} AS INTEGER) + 1) AS c FROM thread_comments),
 b AS (SELECT *, {_SCRIPT} AS script FROM t), f AS (SELECT comment_id, {_term_case()} AS term FROM b) SELECT * FROM f WHERE term IS NOT NULL""",
    "delete_random_alnum": f"WITH {_TEXT} SELECT comment_id FROM t WHERE {_RANDOM}",
    "delete_reason_first": f"{_BASE} SELECT comment_id, {_REASON} AS reason FROM b",
    "dedup_max_likes": f"{_MARKED} SELECT comment_id FROM m WHERE reason IS NULL",
    "dedup_events": f"""{_MARKED}, k AS (SELECT * REPLACE (row_number() OVER (PARTITION BY file_id, sheet ORDER BY row_number, comment_id) + 1 AS row_number) FROM m WHERE reason IS NULL), {_cells('k', 'row_number')}
 SELECT 'delete_row' AS action, file_id, sheet, row_number, '' AS column_header, reason, "评论内容" AS value FROM m WHERE reason IS NOT NULL
 UNION ALL SELECT 'clear_cell', file_id, sheet, row_number, h, reason, v FROM z WHERE reason IS NOT NULL""",
    "subcomment_clear": f"WITH {_cells('thread_comments', 'row_number, comment_id')} SELECT comment_id, h AS column_header, reason FROM z WHERE reason IS NOT NULL",
    "strip_urls": f"SELECT doc_id, CASE WHEN regexp_matches(text, 'https://[^{_S[1:-1]}]') THEN {_strip(f"regexp_replace(text, 'https://[^{_S[1:-1]}]+', '', 'g')")} ELSE text END AS stripped FROM documents",
    "strip_reply_prefix": f"""WITH p AS (SELECT comment_id, CASE WHEN comment_id % 3 = 0 THEN ' 回复 @用户' || row_number || '：' || "评论内容" ELSE "评论内容" END AS v FROM thread_comments)
 SELECT comment_id, regexp_replace(v, '(?s)^{_S}*回复{_S}*@[^:：]+?{_S}*[:：]{_S}*', '') AS body FROM p""",
    "keep_keywords": """SELECT comment_id FROM thread_comments WHERE contains(lower("评论内容"), 'lid') OR contains(lower("评论内容"), '电池') OR contains(lower("评论内容"), 'screw') OR contains(lower("评论内容"), 'ランプ')""",
    "merge_union_order": f"""SELECT file_id AS _file_idx, CASE sheet WHEN '总表' THEN 0 WHEN 'comments' THEN 1 ELSE 2 END AS _sheet_idx, row_number AS _row, "评论内容" AS comment, "一级评论" AS reply,
 file_id || '.csv' AS source_file, sheet AS source_sheet FROM thread_comments WHERE sheet IN ('总表', 'comments', 'Sheet1') AND ({_nonblank('"评论内容"')} IS NOT NULL OR {_nonblank('"一级评论"')} IS NOT NULL)""",
    "inventory_counts": f"""SELECT file_id, sheet, count(*) FILTER ({' OR '.join(_nonblank(f'"{c}"') + ' IS NOT NULL' for c in ('评论内容', '一级评论', '二级评论', '三级评论'))}) AS n_rows FROM thread_comments GROUP BY ALL""",
    "unix_to_beijing": f"WITH {_dated('reviews', 'review_id')} SELECT review_id, {_DAY} AS day FROM d WHERE u IS NOT NULL",
    "relative_dates": f"WITH {_dated('reviews', 'review_id')}, f AS (SELECT review_id, {_RELATIVE} AS day FROM d) SELECT * FROM f WHERE day IS NOT NULL",
    "platform_dates": f"WITH {_dated('reviews', 'review_id')} SELECT review_id, {_PLATFORM_DATE} AS day FROM d",
    "date_product_split": f"""SELECT review_id, CASE WHEN regexp_matches("评论日期", '{_SPLIT}') THEN regexp_extract("评论日期", '{_SPLIT}', 1) WHEN {_nonblank('"评论日期"')} IS NULL THEN NULL ELSE "评论日期" END AS day,
 {_nonblank(f"regexp_extract(\"评论日期\", '{_SPLIT}', 2)")} AS product FROM reviews WHERE date_header = '评论日期与产品'""",
    "normalize_rating": f"""WITH r AS (SELECT review_id, "电商平台评分" AS v, {_digits(_strip('"电商平台评分"'))} AS t FROM reviews), x AS (SELECT *, regexp_extract(t, '{_RATING}', 1) AS g FROM r)
 SELECT review_id, CASE WHEN t = '' THEN NULL WHEN g <> '' AND try_cast(g AS DECIMAL(28,10)) BETWEEN 1 AND 5 THEN CASE WHEN contains(g, '.') THEN rtrim(rtrim(g, '0'), '.') ELSE g END ELSE v END AS rating FROM x""",
    "normalize_likes": f"SELECT review_id, {_likes_text('\"点赞数\"')} AS likes FROM reviews",
    "likes_ranking": f"SELECT review_id, CAST({_LIKES} AS DOUBLE) AS likes FROM reviews",
    "composite_attribute": f"""WITH x AS (SELECT review_id, "用户属性" AS a, regexp_replace("用户属性", '[,，/|｜]', ' ', 'g') AS p FROM reviews),
 y AS (SELECT review_id, CASE WHEN review_id % 3 = 0 THEN a END AS direct, CASE WHEN contains(p, ' ') THEN regexp_extract(p, '(?s)^(.*?) +(.*)$', 1) ELSE p END AS gender,
 CASE WHEN contains(p, ' ') THEN regexp_extract(p, '(?s)^(.*?) +(.*)$', 2) END AS age FROM x)
 SELECT review_id, coalesce({_nonblank('direct')}, {_nonblank_join("' '", 'gender', 'age')}) AS attribute FROM y""",
    "product_fallback": f"""SELECT review_id, coalesce({_nonblank('"产品名"')}, '未命名') AS product FROM reviews""",
    "join_trimmed": f"""SELECT comment_id, {_nonblank_join('chr(10) || chr(10)', '"一级评论"', '"二级评论"', '"三级评论"')} AS joined FROM thread_comments""",
    "rakuten_ops": f"""WITH p AS (SELECT record_id, {_J.format('レビュー投稿日')} AS a, {_J.format('参考になった数')} AS b, {_J.format('レビュアー属性')} AS k, {_J.format('レビュー投稿者')} AS n FROM raw_exports),
 t AS (SELECT *, {_strip('a')} AS ta, {_digits(_strip('b'))} AS tb FROM p WHERE k IS NOT NULL OR n IS NOT NULL)
 SELECT record_id, coalesce({_cal('ta', '^([0-9]{4})[/-]([0-9]{1,2})[/-]([0-9]{1,2})$')},
 strftime(try_cast(regexp_extract(ta, '^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}})$', 3) || '-' || lpad(regexp_extract(ta, '^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}})$', 1), 2, '0') || '-' || lpad(regexp_extract(ta, '^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}})$', 2), 2, '0') AS DATE), '%Y-%m-%d'), a) AS day,
 CASE WHEN regexp_matches(tb, '^[0-9]+{_S}*人$') THEN coalesce(nullif(ltrim(regexp_extract(tb, '^([0-9]+)', 1), '0'), ''), '0') ELSE b END AS likes,
 nullif(concat_ws(' ', nullif(regexp_extract(k, '(男性|女性)', 1), ''), nullif(regexp_replace(regexp_extract(k, '([0-9]{{1,3}}{_S}*(?:代(?:以上)?|歳|才))', 1), '{_S}+', ' ', 'g'), '')), '') AS attribute,
 nullif({_nonblank('n')}, '購入者さん') AS name FROM t""",
    "amazon_ops": f"""WITH p AS (SELECT record_id, {_J.format('查看')} AS a, {_J.format('aiconalt')} AS k, {_J.format('asizebase')} AS b, {_J.format('标题')} AS h, {_J.format('查看1')} AS c FROM raw_exports),
 t AS (SELECT *, {_strip('a')} AS ta, {_digits(_strip('b'))} AS tb, regexp_extract({_strip('k')}, '^([0-9]+(?:\\.[0-9]+)?){_S}*颗星，最多{_S}*5{_S}*颗星$', 1) AS g FROM p WHERE k IS NOT NULL OR a IS NOT NULL)
 SELECT record_id, CASE WHEN ta = '' THEN NULL WHEN regexp_matches(ta, '^[0-9]{{4}}年[0-9]{{1,2}}月[0-9]{{1,2}}日(在.+发布评论)?$') THEN regexp_extract(ta, '^([0-9]{{4}})', 1) || '-' || lpad(regexp_extract(ta, '年([0-9]+)月', 1), 2, '0') || '-' || lpad(regexp_extract(ta, '月([0-9]+)日', 1), 2, '0') ELSE a END AS day,
 CASE WHEN g <> '' AND try_cast(g AS DECIMAL(28,10)) BETWEEN 1 AND 5 THEN g ELSE k END AS rating,
 CASE WHEN regexp_matches(tb, '^[0-9]+{_S}*个人发现此评论有用$') THEN coalesce(nullif(ltrim(regexp_extract(tb, '^([0-9]+)', 1), '0'), ''), '0') ELSE b END AS likes,
 {_nonblank_join('chr(10) || chr(10)', 'h', 'c')} AS body FROM t""",
    "hash_account": f"SELECT c_custkey, {_hmac('CAST(c_custkey AS VARCHAR)', 'youtube', False)} AS hash FROM customer",
    "hash_display": f"SELECT c_custkey, {_hmac('c_name', 'bilibili', True)} AS hash FROM customer",
    "identity_choice": f"""WITH g AS (SELECT file_id, coalesce(bool_or(platform <> 'jd' AND lower({_nonblank('"哈希id"')}) <> 'none'), false) AS used FROM reviews GROUP BY file_id)
 SELECT file_id, CASE WHEN used THEN 'authorChannelId' ELSE 'author' END AS chosen, NOT used AS display FROM g""",
    "standardize_11": f"""WITH {_STD} SELECT comment_id, day AS "评论日期", "评论内容", '未命名' AS "产品名", CAST(NULL AS VARCHAR) AS "电商平台评分", CAST(NULL AS VARCHAR) AS "用户属性", CAST(NULL AS VARCHAR) AS hash_id, likes AS "点赞数", "子评论数/追评数", "一级评论", "二级评论", "三级评论" FROM std""",
    "audit_counts": f"""SELECT count(*) AS n_rows, count(*) FILTER ({_nonblank('"哈希id"')} IS NOT NULL AND NOT regexp_matches("哈希id", '^[0-9a-f]{{64}}$')) AS bad_hash, count(*) FILTER ({_nonblank('"点赞数"')} IS NULL) AS blank_likes FROM reviews""",
    "audit_mapping": f"""WITH {_STD}, c AS (SELECT *, CASE WHEN comment_id % 7 = 0 THEN 'x' || coalesce("评论内容", '') ELSE "评论内容" END AS n_text, CASE WHEN comment_id % 11 = 0 THEN '1999-12-31' ELSE day END AS n_day,
 CASE WHEN comment_id % 13 = 0 THEN '0.50' ELSE likes END AS n_likes, CASE WHEN comment_id % 17 = 0 THEN 'x' || coalesce("一级评论", '') ELSE "一级评论" END AS n_first, CASE WHEN comment_id % 19 = 0 THEN ' ' ELSE "二级评论" END AS n_second FROM std)
 SELECT h AS field, CASE h {' '.join(f"WHEN '{h}' THEN (SELECT count(*) FROM c WHERE {_unequal(a, b)})" for h, a, b in (('评论内容', '"评论内容"', 'n_text'), ('评论日期', 'day', 'n_day'), ('点赞数', 'likes', 'n_likes'), ('一级评论', '"一级评论"', 'n_first'), ('二级评论', '"二级评论"', 'n_second')))} ELSE 0 END AS mismatches
 FROM (SELECT unnest([{', '.join(_q(h) for h in V.ALIASES if h != '哈希ID')}]) AS h)""",
    "audit_sheets": f"""WITH {_STD}, c AS (SELECT *, CASE WHEN file_id % 3 = 0 AND comment_id % 2 = 0 THEN '-1' WHEN comment_id % 10 = 0 THEN '  ' ELSE likes END AS n_likes, NOT (file_id % 5 = 0 AND comment_id % 6 = 0) AS there FROM std)
 SELECT CAST(file_id AS VARCHAR) AS sheet, count(*) FILTER (there) AS n_rows, count(*) AS n_source, count(*) FILTER (there AND comment_id % 4 = 0) AS bad_hash,
 count(*) FILTER (there AND {_nonblank('n_likes')} IS NULL) AS blank_likes, count(*) FILTER (there AND {_unequal('likes', 'n_likes')}) AS mismatches FROM c GROUP BY file_id""",
    "multiset_diff": """WITH l AS (SELECT "评论内容" AS comment FROM thread_comments WHERE sheet = '总表'), r AS (SELECT "评论内容" AS comment FROM thread_comments WHERE sheet <> '总表')
 SELECT comment, 'left' AS side FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) UNION ALL SELECT comment, 'right' FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)""",
    "sequence_diff": """WITH g AS (SELECT file_id || '-' || row_number AS row, min("评论内容") AS a, min("一级评论") AS b FROM thread_comments GROUP BY file_id, row_number)
 SELECT row, a AS left_value, coalesce(b, a) AS right_value FROM g WHERE a IS DISTINCT FROM coalesce(b, a)""",
    "duplicate_groups": f"""SELECT {_nonblank('"评论内容"')} AS value, count(*) AS n, min(comment_id) AS first_row FROM thread_comments WHERE {_nonblank('"评论内容"')} IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "duplicate_summary": f"""WITH g AS (SELECT count(*) AS n FROM thread_comments WHERE {_nonblank('"评论内容"')} IS NOT NULL GROUP BY {_nonblank('"评论内容"')} HAVING count(*) > 1)
 SELECT coalesce(sum(n - 1), 0)::BIGINT AS duplicate_rows, count(*) AS duplicate_groups FROM g""",
    "row_hash": "SELECT n_nationkey, substr(sha256(to_json([n_name, CAST(n_regionkey AS VARCHAR)])::VARCHAR), 1, 12) AS row_hash FROM nation",
    "end_to_end_clean": f"""{_MARKED.replace(_LIKES + ' AS likes', _rank('(' + _likes_text('"点赞数"') + ')') + ' AS likes')}, k AS (SELECT * FROM m WHERE reason IS NULL), {_cells('k', 'row_number, comment_id')}, {_STD},
 gone AS (SELECT comment_id, h FROM z WHERE reason IS NOT NULL)
 SELECT s.comment_id, s.day, s."评论内容" AS comment, s.likes, {', '.join(f'CASE WHEN NOT EXISTS (SELECT 1 FROM gone g WHERE g.comment_id = s.comment_id AND g.h = {_q(c)}) THEN s."{c}" END AS sub{i + 1}' for i, c in enumerate(('一级评论', '二级评论', '三级评论')))}
 FROM std s WHERE s.comment_id IN (SELECT comment_id FROM k)""",
    "x_tree_flatten": f"{_FLAT} SELECT node, root, level, level > 0 AS is_reply FROM w",
    "x_level_summary": f"{_FLAT} SELECT level, count(*) AS n FROM w GROUP BY level",
    "x_links": r"""WITH t AS (SELECT doc_id, concat_ws(' ', text, '[' || doc_id || '](https://example.org/d/' || doc_id || ')', 'http://example.net/q?x=' || doc_id, CASE WHEN doc_id % 2 = 0 THEN 'https://example.org/d/' || doc_id END) AS text FROM documents),
 l AS (SELECT doc_id, regexp_extract_all(text, 'https?://[^\x09-\x0d\x20)\]<>"'']+') AS a FROM t)
 SELECT doc_id, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), '; ') AS links FROM l WHERE len(a) > 0""",
    "x_id_join": "SELECT comment_id, namespace, file_name FROM thread_comments JOIN export_files USING (file_id)",
    "x_merge_roots": """WITH v AS (SELECT file_id, row_number, review_id, {'p': "产品名", 'r': "电商平台评分"} AS v FROM reviews),
 r AS (SELECT file_id, row_number, arg_min(v, review_id) AS a, arg_max(v, review_id) AS b FROM v GROUP BY file_id, row_number)
 SELECT r.file_id || '-' || r.row_number AS key, CASE WHEN p.file_id IS NOT NULL THEN r.file_id || '-' || (r.row_number - 1) END AS parent,
 coalesce(r.a.p, r.b.p, '?') AS product, coalesce(r.a.r, r.b.r, '0') AS rating FROM r LEFT JOIN r p ON p.file_id = r.file_id AND p.row_number = r.row_number - 1""",
}
