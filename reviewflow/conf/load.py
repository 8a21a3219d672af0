"""Configuration files of the four stages: read as JSON, checked strictly, and held against the values this package is built on.

Rules, aliases and layouts are part of the results, so a stage runs with the package's values only. A file is accepted for a
stage if it is the agreed one and says the same; what differs is named, never silently taken over.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path
from typing import Any

from reviewflow.conf import values as V


class ConfigError(ValueError):
    """A configuration that is no valid one, or not the agreed one."""


#: A check takes a value and the place it stands at, and raises.
Check = Callable[[Any, str], None]


def _wrong(at: str, what: str) -> ConfigError:
    return ConfigError(f"{at}: {what}")


def whole(least: int) -> Check:
    def check(v: Any, at: str) -> None:
        if isinstance(v, bool) or not isinstance(v, int) or v < least:
            raise _wrong(at, f"a whole number from {least} is needed")

    return check


def share(v: Any, at: str) -> None:
    if isinstance(v, bool) or not isinstance(v, int | float) or not 0 <= v <= 1:
        raise _wrong(at, "a number between 0 and 1 is needed")


def flag(v: Any, at: str) -> None:
    if not isinstance(v, bool):
        raise _wrong(at, "true or false is needed")


def text(v: Any, at: str) -> None:
    if not isinstance(v, str) or not v.strip():
        raise _wrong(at, "a text that isn't blank is needed")


def one_of(*allowed: object) -> Check:
    def check(v: Any, at: str) -> None:
        if type(v) not in {type(a) for a in allowed} or v not in allowed:
            raise _wrong(at, f"one of {list(allowed)} is needed")

    return check


def texts(empty: bool = True, repeated: bool = False) -> Check:
    def check(v: Any, at: str) -> None:
        if not isinstance(v, list) or not v and not empty:
            raise _wrong(at, "a list of texts is needed")
        for i, x in enumerate(v):
            text(x, f"{at}[{i}]")
        if not repeated and len(set(v)) < len(v):
            raise _wrong(at, "a text stands twice")

    return check


def record(fields: dict[str, Check], optional: tuple[str, ...] = ()) -> Check:
    def check(v: Any, at: str) -> None:
        if not isinstance(v, dict):
            raise _wrong(at, "an object is needed")
        if missing := [k for k in fields if k not in v and k not in optional]:
            raise _wrong(at, f"{missing[0]} is missing")
        if unknown := [k for k in v if k not in fields]:
            raise _wrong(at, f"{unknown[0]} is unknown")
        for k, x in v.items():
            fields[k](x, f"{at}.{k}" if at else k)

    return check


def records(each: Check, key: str) -> Check:
    def check(v: Any, at: str) -> None:
        if not isinstance(v, list) or not v:
            raise _wrong(at, "a list of objects is needed")
        for i, x in enumerate(v):
            each(x, f"{at}[{i}]")
        keys = [x[key] for x in v]
        if len(set(keys)) < len(keys):
            raise _wrong(at, f"a {key} stands twice")

    return check


def groups(v: Any, at: str) -> None:
    if not isinstance(v, dict):
        raise _wrong(at, "an object is needed")
    for k, x in v.items():
        one_of("latin", "chinese", "japanese", "korean", "thai", "hindi", "neutral")(x, f"{at}.{k}")


HEADERS = record({
    "header_row": whole(1), "drop_headers": texts(),
    "output_columns": records(record({"header": text, "aliases": texts(), "required": flag, "composite_aliases": texts(), "generated": flag}, ("required", "composite_aliases", "generated", "aliases")), "header"),
})
CLEANING = record({
    "target_header": text, "twitter_comments_strip_https_urls_from_comment_content": flag, "first_data_row": whole(1), "min_trimmed_length": whole(0),
    "non_chinese_max_short_words": whole(0), "non_chinese_max_short_unspaced_chars": whole(0), "delete_exact_texts": texts(), "delete_contains_texts": texts(),
    "delete_contains_case_insensitive_texts": texts(), "fixed_term_script_group_overrides": groups, "delete_random_alnum_without_chinese": flag,
    "random_digit_min_length": whole(1), "random_letter_min_length": whole(1), "random_mixed_min_length": whole(1), "random_letter_max_vowel_ratio": share,
    "random_letter_min_consonant_run": whole(1), "subcomment_deduplicate_headers": texts(), "subcomment_min_trimmed_length": whole(0),
    "main_comment_duplicate_keep": one_of("max_likes_last_tiebreak"), "main_comment_duplicate_like_header": text, "duplicate_keep": one_of("last"),
    "export_first_sheet_csv": flag, "csv_encoding": text,
})
PLATFORMS = record({"schema_version": one_of(1), "header_row": whole(1), "platforms": records(lambda v, at: _platform(v, at), "namespace")})
IDENTITIES = record({
    "schema_version": one_of(2), "algorithm_version": text,
    "platforms": records(record({"namespace": text, "aliases": texts(), "user_id_headers": texts(), "display_name_headers": texts()}), "namespace"),
})


def _platform(v: Any, at: str) -> None:
    if not isinstance(v, dict):
        raise _wrong(at, "an object is needed")
    text(v.get("namespace"), f"{at}.namespace")
    texts()(v.get("aliases", []), f"{at}.aliases")
    if "variants" in v and (not isinstance(v["variants"], list) or not v["variants"]):
        raise _wrong(f"{at}.variants", "a list of objects is needed")


def read(path: Path, check: Check) -> dict[str, Any]:
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise ConfigError(f"{path} can't be read as JSON: {e}") from None
    check(found, "")
    return found


def cleaning(path: Path) -> list[str]:
    """Names of the settings in which a cleaning configuration differs from the package's values."""
    own = {
        "target_header": "评论内容", "min_trimmed_length": V.MIN_LENGTH, "non_chinese_max_short_words": V.SHORT_WORDS, "non_chinese_max_short_unspaced_chars": V.SHORT_UNSPACED,
        "delete_exact_texts": list(V.PLACEHOLDERS), "delete_contains_texts": list(V.TERMS_EXACT), "delete_contains_case_insensitive_texts": list(V.TERMS_ANY_CASE),
        "fixed_term_script_group_overrides": V.TERM_SCRIPTS, "random_digit_min_length": V.RANDOM_DIGITS, "random_letter_min_length": V.RANDOM_LETTERS,
        "random_mixed_min_length": V.RANDOM_MIXED, "random_letter_max_vowel_ratio": V.VOWEL_RATIO, "random_letter_min_consonant_run": V.CONSONANT_RUN,
        "subcomment_min_trimmed_length": V.SUBCOMMENT_LENGTH,
    }
    found = read(path, CLEANING)
    return [k for k, v in own.items() if found[k] != v]


def headers(path: Path) -> list[str]:
    found = read(path, HEADERS)
    columns = {c["header"]: c for c in found["output_columns"]}
    out = [] if list(columns) == list(V.ALIASES) else ["output_columns"]
    out += [h for h, aliases in V.ALIASES.items() if h in columns and list(aliases) != columns[h].get("aliases", [])]
    return out + ([] if list(V.DROP_HEADERS) == found["drop_headers"] else ["drop_headers"])


def identities(path: Path) -> list[str]:
    found = read(path, IDENTITIES)
    own = {k: {"aliases": x["names"], "user_id_headers": x["accounts"], "display_name_headers": x["display"]} for k, x in V.IDENTITIES.items()}
    theirs = {p["namespace"]: {k: p[k] for k in ("aliases", "user_id_headers", "display_name_headers")} for p in found["platforms"]}
    out = [] if found["algorithm_version"] == V.ALGORITHM else ["algorithm_version"]
    return out + sorted(k for k in own.keys() | theirs.keys() if own.get(k) != theirs.get(k))


def platforms(path: Path) -> list[str]:
    found = read(path, PLATFORMS)
    theirs = {p["namespace"]: p.get("aliases", []) for p in found["platforms"]}
    return sorted(k for k in V.LAYOUT_NAMES.keys() | theirs.keys() if V.LAYOUT_NAMES.get(k) != theirs.get(k))


KINDS = {"cleaning": cleaning, "headers": headers, "platforms": platforms, "identities": identities}


def agreed(kind: str, path: Path, canonical: Path) -> None:
    """A stage accepts its agreed configuration file only, and only if it says what the package does."""
    if Path(path).resolve() != Path(canonical).resolve():
        raise ConfigError(f"{path} is not the agreed configuration")
    if differs := KINDS[kind](path):
        raise ConfigError(f"{path} differs from the package in {', '.join(differs)}")
