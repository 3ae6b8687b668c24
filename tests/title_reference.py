"""Titles in plain Python, for comparison."""

import re
import unicodedata

from siftstone.functions.titles import BRACKETS, ENDS, PAIRS


def cleaner(rules):
    """text -> (name, removed parts), after NFKC."""
    plain = lambda words: sorted({unicodedata.normalize("NFKC", w) for w in words}, key=lambda w: (-len(w), w))
    brands, flavours, promo = sorted(rules.alias(), key=lambda b: (-len(b), b)), plain(rules.flavor_words), plain(rules.promo_words)
    capacity, loose = re.compile(rules.capacity_pattern), str.maketrans(dict.fromkeys(BRACKETS, " "))

    def spare(body):
        for brand in filter(None, brands):
            if brand in body.lower():
                return body[(at := body.lower().index(brand)) : at + len(brand)], True
        kept = []
        for w in flavours:
            if w and w in body:
                kept, body = [*kept, w], body.replace(w, "")
        return " ".join(kept), False

    def clean(title):
        text, removed = unicodedata.normalize("NFKC", title or ""), []
        for a, b in map(lambda p: map(re.escape, p), PAIRS):
            out = ""
            for k, token in enumerate(re.split(f"({a}[^{a}{b}]*{b})", text)):
                kept, is_brand = spare(token[1:-1].strip()) if k % 2 else (token, True)
                out += f" {kept} " if k % 2 else token
                removed += [] if is_brand else [token]
            text = out
        for w in filter(None, promo):
            if w in text:
                removed, text = [*removed, w], " ".join(text.split(w))
        removed += [found.group().strip() for found in capacity.finditer(text)]
        return " ".join(capacity.sub(" ", text).translate(loose).split()).strip(ENDS), removed

    return clean
