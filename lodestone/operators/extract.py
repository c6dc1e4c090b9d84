"""Text extraction from wiki-like pages: page kinds, labels and values, sections, links, stat lines, wikitext.

Flat patterns are Column expressions (one projection over the pages); what needs nesting (top-level
splits, sections, balanced templates) are pure functions with an Arrow-batched wrapper each.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The last path segment of a page's URL and what kind of page it is.
PAGE_TYPES = {
    "spells": "spell", "rituals": "ritual", "mythicspells": "spell", "mythicrituals": "ritual", "feats": "feat", "mythicfeats": "feat",
    "mythicdestinies": "feat", "monsters": "monster", "creatures": "monster", "equipment": "equipment", "weapons": "weapon", "armor": "armor",
    "shields": "shield", "conditions": "condition", "backgrounds": "background", "traits": "trait", "ancestries": "ancestry", "classes": "class",
    "actions": "action", "activities": "action", "hazards": "hazard", "deities": "deity", "archetypes": "archetype",
}
# References decoded by html_to_text, in order.
ENTITIES = [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#x27;", "'"), ("&apos;", "'"), ("&quot;", '"'), ("&mdash;", "—"), ("&ndash;", "–"), ("&bull;", "•"), ("&times;", "×")]


def page_type(url: Column, kinds: dict[str, str] | None = None) -> Column:
    """The kind of a page by its ``.aspx`` name: generic for others, unknown without one."""
    name = F.lower(F.regexp_extract(url, "/([A-Za-z]+)\\.aspx", 1))
    known = F.create_map(*[F.lit(x) for pair in (kinds or PAGE_TYPES).items() for x in pair])
    return F.when(name == "", F.lit("unknown")).otherwise(F.coalesce(F.element_at(known, name), F.lit("generic")))


def html_to_text(html: Column) -> Column:
    """Breaks to spaces, tags off, common references decoded, white space folded."""
    bare = F.regexp_replace(F.regexp_replace(html, "(?i)<br\\s*/?>", " "), "<[^>]+>", "")
    decoded = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, bare)
    return F.trim(F.regexp_replace(decoded, "\\s+", " "))


def links(html: Column) -> Column:
    """array<struct<href, text>> of all anchors, each pair once, in order."""
    pattern = '(?is)<a\\b[^>]*href="([^"]+)"[^>]*>(.*?)</a>'
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("inner"))
    return F.array_distinct(F.transform(pairs, lambda x: F.struct(x["href"].alias("href"), html_to_text(x["inner"]).alias("text"))))


def cross_references(html: Column) -> Column:
    """array<struct<href, text, kind, id>> of links to ``.aspx`` pages."""
    own = F.filter(links(html), lambda x: x["href"].rlike("[A-Za-z][A-Za-z0-9]*\\.aspx"))
    return F.transform(own, lambda x: F.struct(
        x["href"].alias("href"), x["text"].alias("text"),
        F.regexp_extract(x["href"], "([A-Za-z][A-Za-z0-9]*)\\.aspx", 1).alias("kind"),
        F.regexp_extract(x["href"], "(?i)\\?ID=(\\d+)", 1).try_cast("int").alias("id"),
    ))


def head_and_body(html: Column) -> Column:
    """struct<head, body>: around the first rule, else after the source line, else all head."""
    rule = F.regexp_instr(html, F.lit("(?i)<hr\\s*/?>"))
    rule_text = F.regexp_extract(html, "(?i)(<hr\\s*/?>)", 1)
    source = F.regexp_extract(html, "(?is)^(.*?<b>\\s*Source\\s*</b>.*?<br\\s*/?>)", 1)
    return (
        F.when(rule > 0, F.struct(html.substr(F.lit(1), rule - 1).alias("head"), html.substr(rule + F.length(rule_text), F.length(html)).alias("body")))
        .when(source != "", F.struct(source.alias("head"), html.substr(F.length(source) + 1, F.length(html)).alias("body")))
        .otherwise(F.struct(html.alias("head"), F.lit("").alias("body")))
    )


def fields(head: Column) -> Column:
    """array<struct<label, value>>: ``<b>Label</b> value`` pairs of all lines; the source line is left out.

    A line is cut at semicolons before a label, and a value ends at the next label.
    """
    lines = F.split(F.regexp_replace(head, "(?i);\\s*(?=<b>)", "<br>"), "(?i)<br\\s*/?>")
    pattern = "(?is)<b>\\s*([^<]+?)\\s*</b>\\s*(.*?)(?=<b>|$)"
    pairs = F.flatten(F.transform(lines, lambda x: F.arrays_zip(F.regexp_extract_all(x, F.lit(pattern), F.lit(1)).alias("l"), F.regexp_extract_all(x, F.lit(pattern), F.lit(2)).alias("v"))))
    told = F.transform(pairs, lambda x: F.struct(F.trim(F.regexp_replace(F.regexp_replace(x["l"], ":$", ""), "\\s+", " ")).alias("label"), html_to_text(x["v"]).alias("value")))
    return F.filter(told, lambda x: (x["label"] != "") & (x["value"] != "") & (F.lower(x["label"]) != "source"))


def field_map(found: Column) -> Column:
    """The first value of each label."""
    labels = F.array_distinct(F.transform(found, lambda x: x["label"]))
    return F.map_from_arrays(labels, F.transform(labels, lambda k: F.element_at(F.filter(found, lambda x: x["label"] == k), 1)["value"]))


def as_int(text: Column) -> Column:
    """The first integer in a text."""
    return F.regexp_extract(text, "(-?\\d+)", 1).try_cast("int")


def unless_dash(value: Column, raw: Column) -> Column:
    """NULL where the raw text is a dash."""
    return F.when(F.trim(raw).isin("—", "–", "-"), F.lit(None)).otherwise(value)


def price(text: Column) -> Column:
    """A price in copper pieces: gp, sp and cp amounts added."""
    amount = lambda unit, n: F.coalesce(F.regexp_replace(F.regexp_extract(text, f"(?i)([\\d,]+)\\s*{unit}", 1), ",", "").try_cast("long"), F.lit(0)) * n
    return F.when(text.rlike("(?i)\\d\\s*(?:pp|gp|sp|cp)"), amount("pp", 1000) + amount("gp", 100) + amount("sp", 10) + amount("cp", 1))


def dice(text: Column) -> Column:
    """struct<count, sides, bonus, kind> of damage such as ``2d6+3 fire``."""
    pattern = "(\\d+)d(\\d+)(?:\\s*([+-]\\s*\\d+))?(?:\\s+([a-z]+))?"
    part = lambda i: F.regexp_extract(text, pattern, i)
    return F.when(text.rlike(pattern), F.struct(part(1).try_cast("int").alias("count"), part(2).try_cast("int").alias("sides"), F.coalesce(F.regexp_replace(part(3), "\\s", "").try_cast("int"), F.lit(0)).alias("bonus"), F.nullif(part(4), F.lit("")).alias("kind")))


def modifiers(text: Column, names: tuple[str, ...]) -> Column:
    """map<string, int> of ``Name +3`` pairs, such as abilities, saves and skills."""
    found = [F.when(text.rlike(f"(?i)\\b{n}\\s*[+-]?\\d"), F.struct(F.lit(n).alias("k"), F.regexp_replace(F.regexp_extract(text, f"(?i)\\b{n}\\s*([+-]?\\d+)", 1), "\\+", "").try_cast("int").alias("v"))) for n in names]
    return F.map_from_entries(F.array_compact(F.array(*found)))


ABILITIES = ("Str", "Dex", "Con", "Int", "Wis", "Cha")


def stat_block(told: Column) -> Column:
    """The usual numbers of a stat block from a field map: AC, HP, saves, perception, speed, abilities, immunities."""
    get = lambda k: F.try_element_at(told, F.lit(k))
    listed = lambda k: F.filter(F.transform(F.split(F.coalesce(get(k), F.lit("")), ",\\s*"), F.trim), lambda x: x != "")
    return F.struct(
        as_int(get("AC")).alias("ac"), as_int(get("HP")).alias("hp"), as_int(get("Fort")).alias("fort"), as_int(get("Ref")).alias("ref"), as_int(get("Will")).alias("will"),
        as_int(get("Perception")).alias("perception"), as_int(get("Speed")).alias("speed"),
        listed("Languages").alias("languages"), listed("Immunities").alias("immunities"), listed("Weaknesses").alias("weaknesses"), listed("Resistances").alias("resistances"),
        F.map_from_arrays(F.array(*[F.lit(a) for a in ABILITIES]), F.array(*[as_int(get(a)) for a in ABILITIES])).alias("abilities"),
    )


def spell_facts(told: Column) -> Column:
    """Traditions, cast, range, area, save and duration of a spell from a field map."""
    get = lambda k: F.try_element_at(told, F.lit(k))
    return F.struct(
        F.filter(F.transform(F.split(F.coalesce(get("Traditions"), F.lit("")), ",\\s*"), F.trim), lambda x: x != "").alias("traditions"),
        get("Cast").alias("cast"), get("Range").alias("range"), get("Area").alias("area"),
        F.nullif(F.lower(F.regexp_extract(F.coalesce(get("Saving Throw"), get("Defense"), F.lit("")), "(?i)(fortitude|reflex|will)", 1)), F.lit("")).alias("save"),
        F.coalesce(get("Saving Throw"), F.lit("")).rlike("(?i)^basic").alias("basic_save"), get("Duration").alias("duration"),
    )


def equipment_facts(told: Column) -> Column:
    """Price in copper, bulk, hands, damage and range of equipment from a field map."""
    get = lambda k: F.try_element_at(told, F.lit(k))
    return F.struct(price(get("Price")).alias("price_cp"), unless_dash(get("Bulk"), get("Bulk")).alias("bulk"), unless_dash(get("Hands"), get("Hands")).alias("hands"), dice(get("Damage")).alias("damage"), as_int(get("Range")).alias("range_feet"))


def pages_to_records(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with kind, title, fields and the facts of its kind: the dispatcher, as one projection."""
    parts = pages.withColumn("page_type", page_type(F.col(url))).withColumn("_p", head_and_body(F.col(html)))
    parts = parts.withColumn("_f", fields(F.col("_p.head"))).withColumn("field_map", field_map(F.col("_f")))
    m = F.col("field_map")
    return parts.withColumns({
        "title": html_to_text(F.regexp_extract(html, "(?is)<h1[^>]*>(.*?)</h1>", 1)),
        "body_text": html_to_text(F.col("_p.body")),
        "links": cross_references(F.col(html)),
        "stats": F.when(F.col("page_type") == "monster", stat_block(m)),
        "spell": F.when(F.col("page_type").isin("spell", "ritual"), spell_facts(m)),
        "item": F.when(F.col("page_type").isin("equipment", "weapon", "armor", "shield"), equipment_facts(m)),
    }).drop("_p", "_f")


# Functions on nested text.


def split_top_level(text: str, separator: str = ",") -> list[str]:
    """Trimmed parts between separators that stand outside all brackets."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        if ch in "([{":
            depth += 1
        elif ch in ")]}":
            depth = max(0, depth - 1)
        elif ch == separator and not depth:
            out.append(text[start:i].strip())
            start = i + 1
    return [p for p in (*out, text[start:].strip()) if p]


def sections(html: str) -> list[dict]:
    """Headings of level 2 and 3 with the text up to the next heading."""
    heads = list(re.finditer(r"<h([1-3])\b[^>]*>(.*?)</h\1>", html, re.DOTALL | re.IGNORECASE))
    plain = lambda s: " ".join(re.sub(r"<[^>]+>", "", re.sub(r"(?i)<br\s*/?>", " ", s)).split())
    out = []
    for i, h in enumerate(heads):
        end = heads[i + 1].start() if i + 1 < len(heads) else len(html)
        if h[1] != "1" and plain(h[2]):
            out.append({"heading": plain(h[2]), "level": int(h[1]), "text": plain(html[h.end() : end])})
    return out


def templates(wikitext: str) -> list[dict]:
    """Balanced ``{{name|key=value|...}}`` templates, outermost first, with positional arguments numbered."""
    out, stack = [], []
    i = 0
    while i < len(wikitext) - 1:
        two = wikitext[i : i + 2]
        if two == "{{":
            stack.append(i)
            i += 2
        elif two == "}}" and stack:
            start = stack.pop()
            if not stack:
                parts = _arguments(wikitext[start + 2 : i])
                args, n = {}, 0
                for p in parts[1:]:
                    key, eq, value = _keyed(p)
                    if not eq:
                        n += 1
                        key, value = str(n), p
                    args.setdefault(key.strip(), value.strip())
                out.append({"name": parts[0].strip(), "arguments": args})
            i += 2
        else:
            i += 1
    return out


def _keyed(part: str) -> tuple[str, str, str]:
    depth = 0
    for i, ch in enumerate(part):
        depth += (ch in "{[") - (ch in "}]")
        if ch == "=" and depth <= 0:
            return part[:i], "=", part[i + 1 :]
    return part, "", ""


def _arguments(body: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, ch in enumerate(body):
        depth += (ch in "{[") - (ch in "}]")
        if ch == "|" and depth <= 0:
            out.append(body[start:i])
            start = i + 1
    return [*out, body[start:]]


def clean_wikitext(text: str) -> str:
    """Links and tooltips to their text, markup and templates off."""
    text = re.sub(r"\{\{(?:tt|tooltip)\|([^|{}]*)\|[^{}]*\}\}", r"\1", text)
    text = re.sub(r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", r"\1", text)
    text = re.sub(r"<ref[^>]*>.*?</ref>|<[^>]+>|'{2,}", "", text, flags=re.DOTALL)
    while (shorter := re.sub(r"\{\{[^{}]*\}\}", "", text)) != text:
        text = shorter
    return " ".join(text.split())


def _wrapped(function, kind: str):  # noqa: ANN001, ANN202
    def run(batch: pd.Series) -> pd.Series:
        return pd.Series([function(t or "") for t in batch])

    return F.pandas_udf(run, kind)


def section_column(html: Column) -> Column:
    """``sections`` of each text."""
    return _wrapped(sections, "array<struct<heading:string,level:int,text:string>>")(html)


def template_column(wikitext: Column) -> Column:
    """``templates`` of each text."""
    return _wrapped(templates, "array<struct<name:string,arguments:map<string,string>>>")(wikitext)


def top_level_column(text: Column) -> Column:
    """``split_top_level`` of each text."""
    return _wrapped(split_top_level, "array<string>")(text)


def wiki_class(title: Column, wikitext: Column, rules: list[dict]) -> Column:
    """The first rule's class that fits: ``{className, title?, template?}`` with patterns over title and text."""
    out = F.lit("Generic")
    for r in reversed(rules):
        tests = ([title.rlike(r["title"])] if r.get("title") else []) + ([wikitext.rlike("\\{\\{\\s*" + r["template"])] if r.get("template") else [])
        out = F.when(reduce(lambda a, b: a & b, tests), F.lit(r["className"])).otherwise(out)
    return out
