"""Text functions."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from factspark import fixed

YEAR = r"(17|18|19|20|21)\d{2}"


def _word(alternatives) -> str:
    return r"\b(" + "|".join(re.escape(x).replace("\\ ", " ") for x in alternatives) + r")\b"


@lru_cache(1)
def _folds() -> tuple[str, str, str, dict[str, str]]:
    """What compatibility decomposition without combining marks does to code points, as far as names can tell.

    Returns a class of code points that vanish, equally long strings of those
    that become one ASCII character and of these characters, and a map of all
    others (several characters, or beyond the basic plane) that become text with
    ASCII letters, digits or parentheses. Whatever else a code point becomes is
    a blank in a normalised name, and so is the code point itself.
    """
    gone, source, target, many = [], [], [], {}
    for i in range(0x80, sys.maxunicode + 1):
        ch = chr(i)
        out = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if not out:
            gone.append(i)
        elif out != ch and re.search(r"[A-Za-z0-9()]", out):
            if len(out) == 1 and i < 0x10000:
                source.append(ch)
                target.append(out)
            else:
                many[ch] = out
    spans: list[list[int]] = []
    for i in gone:
        if 0xD800 <= i < 0xE000:
            continue
        if spans and spans[-1][1] == i - 1:
            spans[-1][1] = i
        else:
            spans.append([i, i])
    marks = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in spans) + "]+"
    return marks, "".join(source), "".join(target), many


def normalize_name(text: Column) -> Column:
    """Letters without marks, in lower case, and digits; parentheses with what they hold are gone, all else is one blank.

    Equal names are taken for equal things. Null stays null. The expression is
    long: compute it once into a column, rather than once for each comparison.
    """
    marks, source, target, many = _folds()
    expand = F.str_to_map(F.lit("\x01".join(f"{a}\x02{b}" for a, b in many.items())), F.lit("\x01"), F.lit("\x02"))  # one literal, folded once
    # The long classes and the map are for the few texts, and characters, beyond Latin-1 and its fractions.
    far = lambda c: (c >= "\u0100") | c.between("\u00bc", "\u00be")
    each = F.transform(F.split(text, ""), lambda c: F.when(far(c), F.coalesce(F.try_element_at(expand, c), c)).otherwise(c))
    spelled = F.when(text.rlike("[\\u00BC-\\u00BE\\u0100-\\x{10FFFF}]"), F.array_join(each, "")).otherwise(text)
    unmarked = F.when(text.rlike("[\\u0300-\\x{10FFFF}]"), F.regexp_replace(spelled, marks, "")).otherwise(spelled)
    plain = F.translate(unmarked, source, target)
    # Text in ASCII alone, by far the most common, takes none of these steps.
    folded = F.lower(F.when(text.rlike("[^\\x00-\\x7F]"), plain).otherwise(text))
    bare = F.regexp_replace(F.regexp_replace(folded, r"\([^)]*\)", ""), r"[^a-z0-9]+", " ")
    return F.trim(bare)


def has_year(text: Column) -> Column:
    return text.rlike(rf"(?U)\b{YEAR}\b")


def has_temporal_text(text: Column, extra: bool = False) -> Column:
    """A year, an ISO date, a month's name or a phrase that ties the text to a time."""
    phrases = (*fixed.MONTHS, *fixed.TEMPORAL_PHRASES, *(fixed.EXTRA_TEMPORAL_PHRASES if extra else ()))
    return text.rlike(rf"(?iU)\b{YEAR}\b|\b\d{{4}}-\d{{2}}-\d{{2}}\b|{_word(phrases)}")


def targets_mutable_fact(question: Column) -> Column:
    low = F.lower(question)
    return F.exists(F.array(*(F.lit(x) for x in (*fixed.RELATIONSHIP_HINTS, *fixed.STATISTIC_HINTS))), lambda hint: F.contains(low, hint))


def is_simple_question(question: Column) -> Column:
    return ~F.lower(question).rlike("|".join(fixed.NOT_SIMPLE)) & (F.char_length(strip(question)) <= fixed.SIMPLE_LENGTH)


def strip(text: Column) -> Column:
    """The text without white space (of any script) around it."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def strip_year_tokens(label: Column) -> Column:
    """The label without years, and without blanks and ``-,:`` around it."""
    return F.btrim(F.regexp_replace(F.regexp_replace(label, rf"(?U)\b{YEAR}\b", ""), r"(?U)\s+", " "), F.lit(" -,:"))


def ordinal(n: Column) -> Column:
    """1st, 2nd, 3rd, 4th ... 11th, 12th, 13th ... 21st"""
    last = n % 10
    suffix = F.when((n % 100).between(10, 20), "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), suffix)


def last_segment(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def entity_id(kind: Column, value: Column) -> Column:
    """The id at the end of an entity's address; null for other addresses, literals and blank nodes."""
    return F.when((kind == "uri") & value.startswith(fixed.ENTITY_PREFIX), last_segment(value))


def answer_key(kind: Column, value: Column, datatype: Column) -> Column:
    """What tells answers apart: the entity's id, or the literal with its type."""
    return F.coalesce(entity_id(kind, value), F.concat_ws(":", F.lit("VALUE"), F.coalesce(datatype, F.lit("literal")), F.coalesce(value, F.lit(""))))


def is_id_like(label: Column) -> Column:
    return label.rlike(r"(?U)\AQ\d+\z")


def located(label: Column, place: Column) -> Column:
    return F.concat(label, F.lit(" in "), place)


def cache_key(accept: Column, url: Column) -> Column:
    return F.sha2(F.concat(accept, F.lit("\n"), url), 256)


def normalize_style(style: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in fixed.STYLES.items() for x in pair))
    return F.coalesce(F.try_element_at(known, style), style)


def is_multi_hop(style: Column) -> Column:
    return normalize_style(style).isin(*fixed.MULTI_HOP_STYLES)


def fill(template: Column, slots: dict[str, Column]) -> Column:
    """The template with each ``{slot}`` filled; what a slot's text holds is never filled again.

    The template is cut at its braces first, so every slot is filled in one
    pass. Null if a slot of the template isn't known, or its text is null.
    """
    values = F.create_map(*(x for name, text in slots.items() for x in (F.lit(name), text)))
    parts = F.split(template, r"[{}]")  # texts at even places, slots at odd ones
    filled = F.transform(parts, lambda part, i: F.when(i % 2 == 0, part).otherwise(F.try_element_at(values, part)))
    return F.when(F.forall(filled, lambda x: x.isNotNull()), F.array_join(filled, ""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda x: x != "")


def json_object(text: Column) -> Column:
    """From the first opening to the last closing brace; null without them."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)
