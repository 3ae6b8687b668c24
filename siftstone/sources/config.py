"""Rule files, column maps and done lists: small documents that the driver reads and checks."""

from __future__ import annotations

import contextlib
import json
import re
import unicodedata
from decimal import Decimal
from pathlib import Path

from siftstone.operators.offers import FIELDS, SORT_FIELDS, Rules

# The keys of a rule file, what they may hold, and whether they must be there.
RULE_KEYS = {
    "stage": "number", "categories": "words", "later_stage_categories": "words", "min_monthly_sales": "number", "trap_commission_min": "number",
    "same_product_min_stores": "number", "same_flavor_max_reject": "number", "done_policy": "policies", "require_bonus": "flag", "offer_end_policy": "end",
    "sort": "order", "promo_words": "list", "flavor_words": "list", "capacity_pattern": "pattern", "brand_aliases": "words?",
}
DONE_POLICIES, END_POLICIES = ("exclude", "demote", "mark"), ("exclude_member", "mark")
DONE_KEYS = ("same_brand_same_series", "same_brand_other_series")


class ConfigError(ValueError):
    """A document that can't be used; the message says where."""


def decode(data: bytes, where: str = "") -> str:
    """UTF-8 with or without a byte order mark, else cp950."""
    for encoding in ("utf-8-sig", "cp950"):
        try:
            return data.decode(encoding)
        except UnicodeDecodeError:
            continue
    raise ConfigError(f"{where}: neither UTF-8 nor cp950")


def load_json(path: str) -> dict:
    """A JSON object in UTF-8; keys that begin with _ are comments."""
    document = None
    with contextlib.suppress(ValueError):
        document = json.loads(_bytes(path).decode("utf-8-sig"))
    if type(document) is not dict:
        raise ConfigError(f"{path}: no JSON object")
    return {key: document[key] for key in document if key[:1] != "_"}


def _bytes(path: str) -> bytes:
    try:
        return Path(path).read_bytes()
    except OSError as e:
        raise ConfigError(f"{path}: {e.strerror}") from e


def load_done(path: str) -> tuple[tuple[str, str], ...]:
    """Lines `brand｜series` (or |), UTF-8 or cp950; # begins a comment line; no series means the whole brand."""
    lines = (unicodedata.normalize("NFKC", line).strip() for line in decode(_bytes(path), path).splitlines())
    return tuple((brand.strip(), series.strip()) for brand, _, series in (line.partition("|") for line in lines if line and line[0] != "#"))


def _is_words(value) -> bool:
    return isinstance(value, list) and all(isinstance(w, str) for w in value)


def _is_order(value) -> bool:
    return _is_words(value) and all(re.fullmatch(rf"({'|'.join(SORT_FIELDS)})\s+(asc|desc)", s.strip()) for s in value)


def _is_pattern(value) -> bool:
    with contextlib.suppress(re.error, TypeError):
        return bool(re.compile(value))
    return False


_HOLDS = {
    "number": lambda v: bool(re.fullmatch(r"-?\d+(\.\d+)?", str(v))),
    "words": lambda v: isinstance(v, dict) and all(map(_is_words, v.values())),
    "list": _is_words,
    "flag": lambda v: isinstance(v, bool),
    "policies": lambda v: isinstance(v, dict) and all(v.get(k) in DONE_POLICIES for k in DONE_KEYS),
    "end": lambda v: v in END_POLICIES,
    "order": _is_order,
    "pattern": _is_pattern,
}


def rule_problems(raw: dict) -> list[str]:
    """All that is wrong with a rule file's keys: lacking ones, and those that hold what they may not."""
    lacking = [f"{key} is lacking" for key, what in RULE_KEYS.items() if key not in raw and what[-1] != "?"]
    return lacking + [f"{key}: not {what.rstrip('?')}" for key, what in RULE_KEYS.items() if key in raw and not _HOLDS[what.rstrip("?")](raw[key])]


def load_rules(path: str, done: tuple[tuple[str, str], ...] = ()) -> Rules:
    raw = load_json(path)
    if problems := rule_problems(raw):
        raise ConfigError(f"{path}: {'; '.join(problems)}")
    made = {"number": lambda v: Decimal(str(v)), "list": tuple, "order": tuple}
    values = {key: made.get(what, lambda v: v)(raw[key]) for key, what in RULE_KEYS.items() if key in raw}
    whole = {key: int(values[key]) for key in ("stage", "same_product_min_stores", "same_flavor_max_reject")}
    return Rules(**values | whole, done=done)


def load_columns(path: str) -> dict[str, list[str]]:
    """Field -> header aliases."""
    raw = load_json(path)
    if strange := [k for k in raw if k not in FIELDS]:
        raise ConfigError(f"{path}: unknown fields {', '.join(strange)}")
    return raw


def header_map(header: list[str], columns: dict[str, list[str]], where: str = "") -> list[str]:
    """The field of each header; an unknown one, or two for one field, is an error."""
    fold = lambda t: unicodedata.normalize("NFKC", t).strip().casefold()
    known = {fold(a): f for f, names in columns.items() for a in [f, *names]}
    if unknown := [h for h in header if fold(h) not in known]:
        raise ConfigError(f"{where}: unknown columns {', '.join(unknown)}")
    fields = [known[fold(h)] for h in header]
    if twice := sorted({f for f in fields if fields.count(f) > 1}):
        raise ConfigError(f"{where}: two columns for {', '.join(twice)}")
    return fields
