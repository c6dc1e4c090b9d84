"""Records from the pages of a rules wiki and of a card and game wiki: the nested facts of each page class.

A page becomes one record (a JSON object, then a VARIANT) by its kind. A rules page is a content span with a
title line, trait pills, labelled values (``<b>Label</b> value``) above a rule, and a body with sections. What a
kind's record holds is told by a table: field, labels, and how the value is read; what a table cannot say
(strikes, spell lists, afflictions, variants) has a reader of its own. A wikitext page is classed by its
templates, then by its title, and its record holds the arguments that a table names.

The readers are pure functions of one page; the column wrappers run them in Arrow batches, one pass over the
pages, nothing shuffled.
"""

from __future__ import annotations

import html as entities
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.extract import PAGE_TYPES, split_top_level, templates

# Action glyphs, save names, trait classes, ordinals, sizes of an ancestry.
ACTIONS = {"one-action": "one-action", "single-action": "one-action", "two-actions": "two-actions", "three-actions": "three-actions", "reaction": "reaction", "free-action": "free-action"}
SAVES = {"fortitude": "fort", "reflex": "ref", "will": "will"}
RARITIES = [("traitunique", "unique"), ("traitrare", "rare"), ("traituncommon", "uncommon")]
TRADITIONS = ("arcane", "divine", "occult", "primal", "elemental")
OUTCOMES = ("critical success", "success", "failure", "critical failure")
ABILITIES = ("str", "dex", "con", "int", "wis", "cha")
ATTRIBUTES = ("Strength", "Dexterity", "Constitution", "Intelligence", "Wisdom", "Charisma")
AFFLICTIONS = ("disease", "poison", "curse", "venom", "toxin", "hex", "infection", "plague", "affliction")
#: Labels of a stat block that name no ability of their own.
STAT_LABELS = frozenset(
    ["source", "recall knowledge", "perception", "languages", "skills", *ABILITIES, "ac", "fort", "ref", "will", "hp", "hardness", "immunities", "weaknesses", "resistances", "speed", "melee", "ranged",
     "damage", "cast", "trigger", "frequency", "effect", "requirements", "saving throw", "maximum duration", "onset", "items"]
)
DASHES = ("—", "–", "-", "")

# Text.


def plain(fragment: str | None) -> str:
    """The text of a fragment: breaks are spaces, tags go, references are decoded, white space is folded."""
    bare = re.sub(r"<[^>]+>", "", re.sub(r"(?i)<br\s*/?>", " ", fragment or ""))
    return " ".join(entities.unescape(bare).split())


def number(text: str | None) -> int | None:
    """The first whole number of a text."""
    m = re.search(r"-?\d+", text or "")
    return int(m[0]) if m else None


def said(text: str | None) -> str | None:
    """The text, unless it is empty or a dash."""
    return None if text is None or text.strip() in DASHES else text.strip()


def listed(text: str | None) -> list[str]:
    """The parts of a comma-separated list."""
    return split_top_level(text or "")


def labelled(fragment: str) -> list[tuple[str, str]]:
    """(label, HTML of its value) of each bold label, in order: a value ends at the next label or line."""
    out = []
    for line in re.split(r"(?i)<br\s*/?>|;\s*(?=<b>)", fragment):
        marks = list(re.finditer(r"(?i)<b>\s*([^<]+?)\s*</b>", line))
        for m, after in zip(marks, [*(x.start() for x in marks[1:]), len(line)]):
            out.append((" ".join(m[1].removesuffix(":").split()), line[m.end() : after].strip()))
    return out


class Labels:
    """Labelled values by name, whatever their case; of several the first."""

    def __init__(self, fragment: str):
        self.pairs = [(k, v) for k, v in labelled(fragment) if k and plain(v)]

    def html(self, *names: str) -> str | None:
        return next((v for n in names for k, v in self.pairs if k.lower() == n.lower()), None)

    def text(self, *names: str) -> str | None:
        found = self.html(*names)
        return None if found is None else plain(found)


def after(fragment: str, label: str, stop: str = r"<b>|<h[1-6]|$") -> str | None:
    """The text behind a bold label wherever it stands, up to ``stop``."""
    m = re.search(rf"(?is)<b>\s*{label}\s*</b>(.*?)(?={stop})", fragment)
    return (plain(m[1]).strip(" ;,") or None) if m else None


def links(fragment: str) -> list[dict]:
    """The references to pages of the wiki, each (href, text) once, in order."""
    out = {}
    for m in re.finditer(r'(?is)<a\b[^>]*href="([^"]+)"[^>]*>(.*?)</a>', fragment):
        if kind := re.search(r"([A-Za-z][A-Za-z0-9]*)\.aspx", m[1]):
            ident = re.search(r"(?i)\?ID=(\d+)", m[1])
            out.setdefault((m[1], plain(m[2])), {"href": m[1], "text": plain(m[2]), "kind": kind[1], "id": int(ident[1]) if ident else None})
    return list(out.values())


def named(fragment: str | None, key: str, kind: str | None = None) -> list[dict]:
    """Links of a fragment as {name, <key>}; ``kind`` keeps those to one page."""
    return [{"name": x["text"], key: x["id"]} for x in links(fragment or "") if x["text"] and kind in (None, x["kind"])]


def element(page: str, start: int, name: str) -> str:
    """The inner HTML of the element whose tag starts at ``start``, by counting tags of its name."""
    open_end = page.index(">", start) + 1
    depth = 1
    for m in re.finditer(rf"(?i)<(/?){name}\b[^>]*>", page[open_end:]):
        depth += -1 if m[1] else 1
        if not depth:
            return page[open_end : open_end + m.start()]
    return page[open_end:]


def glyph(fragment: str) -> str | None:
    """The cost of the first action glyph, from its text or its label."""
    m = re.search(r"""(?i)<span\s+class=['"]action['"]([^>]*)>\s*(?:\[([a-z-]+)\])?""", fragment)
    if not m:
        return None
    told = re.search(r"""aria-label=['"]([^'"]+)['"]""", m[1])
    return ACTIONS.get((m[2] or (told[1] if told else "")).lower().replace(" ", "-"))


def unglyphed(fragment: str) -> str:
    return re.sub(r"""(?is)<span\s+class=['"]action['"][^>]*>.*?</span>""", " ", fragment)


# The page as a whole.


def content(page: str) -> str | None:
    """The span that holds the title and a source, else that of the first title."""
    spans = []
    for h in re.finditer(r"""(?i)<h1[^>]*class=['"][^'"]*\btitle\b""", page):
        around = [m.start() for m in re.finditer(r"(?i)<span\b", page[: h.start()])]
        for start in reversed(around):
            inner = element(page, start, "span")
            if page.index(">", start) + 1 + len(inner) > h.start():
                spans.append(inner)
                break
    chosen = next((s for s in spans if re.search(r"(?i)<b>\s*Source\s*</b>", s)), spans[0] if spans else None)
    if chosen and (own := re.search(r"""(?i)<span[^>]*class=['"]monster-page['"]""", chosen)):
        return element(chosen, own.start(), "span")
    return chosen


def title(span: str, page: str) -> dict:
    """Name, level and kind, action cost, legality, edition."""
    heads = [m[2] for m in re.finditer(r"""(?is)<h1([^>]*class=['"][^'"]*\btitle\b[^>]*)>(.*?)</h1>""", span)]
    head = next((h for h in heads if "margin-left:auto" in h), heads[0] if heads else "")
    label = re.search(r"""(?is)<span[^>]*margin-left:auto[^>]*>(.*?)</span>""", head)
    level_label = plain(label[1]) if label else None
    own = re.sub(r"""(?is)<span[^>]*(?:margin-left:auto|float:left)[^>]*>.*?</span>|<a[^>]*PFS\.aspx[^>]*>.*?</a>""", "", unglyphed(head))
    level = re.match(r"([A-Za-z]+)(?:\s+(-?\d+)(\+?))?", level_label or "")
    badge = re.search(r"""(?i)<img[^>]*alt=['"]PFS\s+(standard|limited|restricted)""", span)
    look = re.search(r"""(?is)<div[^>]*siderbarlook[^>]*>.*?<a[^>]*href=['"]([^'"]+)""", span)
    return {
        "name": plain(own), "level_label": level_label, "level_kind": level[1] if level else None, "level": int(level[2]) if level and level[2] else None, "tiered": bool(level and level[3]),
        "action_cost": glyph(head), "pfs": badge[1].lower() if badge else None, "legacy": "legacy-content-warning" in page, "alt_edition_url": look[1] if look else None,
    }


def traits(span: str) -> dict:
    """Trait pills in order, each once, and what their classes tell: rarity, size, alignment."""
    out: dict = {"traits": [], "rarity": "common", "size": None, "alignment": None, "trait_ids": {}}
    for m in re.finditer(r"""(?is)<span[^>]*class=['"](trait\w*)['"][^>]*>(.*?)</span>""", span):
        name, kind = plain(m[2]), m[1].lower()
        if not name or name in out["traits"]:
            continue
        out["traits"].append(name)
        out["rarity"] = next((r for c, r in RARITIES if c in kind), out["rarity"])
        if kind in ("traitsize", "traitalignment"):
            out[kind.removeprefix("trait")] = name
        if ident := re.search(r"(?i)\?ID=(\d+)", m[2]):
            out["trait_ids"][name] = int(ident[1])
    return out


def sources(span: str) -> list[dict]:
    """Every source reference: book, page, identifier."""
    out = []
    for m in re.finditer(r"""(?is)<b>\s*Source\s*</b>\s*<a[^>]*href="[^"]*Sources\.aspx\?ID=(\d+)"[^>]*>\s*<i>([^<]+)</i>\s*</a>""", span):
        told = plain(m[2])
        page = re.match(r"(.*?)\s*pg\.\s*(\d+)", told)
        out.append({"book": page[1].strip() if page else told, "page": int(page[2]) if page else None, "source_id": int(m[1]), "raw": told})
    return out


def halves(span: str) -> tuple[str, str]:
    """What stands above and below the first rule, else the end of the source line."""
    m = re.search(r"(?i)<hr\s*/?>", span) or re.search(r"(?is)<b>\s*Source\s*</b>.*?<br\s*/?>", span)
    if m is None:
        return span, ""
    return (span[: m.start()] if m[0].lower().startswith("<hr") else span[: m.end()]), span[m.end() :]


def section_list(span: str) -> list[dict]:
    """Titled headings of level 2 and 3, each with what follows up to the next heading."""
    heads = list(re.finditer(r"(?is)<h([1-3])\b([^>]*)>(.*?)</h\1>", span))
    out = []
    for m, end in zip(heads, [*(h.start() for h in heads[1:]), len(span)]):
        if m[1] != "1" and re.search(r"\btitle\b", m[2]) and not re.search(r"feel-title|hide-on-print|legacy-content-warning", m[2]) and plain(m[3]):
            body = span[m.end() : end]
            out.append({"heading": plain(m[3]), "level": int(m[1]), "body_html": body, "body_text": plain(body), "links": links(body)})
    return out


class Page:
    """Everything that the readers of all kinds share."""

    def __init__(self, span: str, page: str, url: str):
        self.url, self.span = url, span
        self.head, self.body = halves(span)
        self.title, self.traits, self.sources = title(span, page), traits(span), sources(span)
        self.fields = Labels(self.head)
        self.fields.pairs = [(k, v) for k, v in self.fields.pairs if k.lower() != "source"]
        self.sections, self.links = section_list(span), links(span)

    def section(self, pattern: str) -> dict | None:
        return next((s for s in self.sections if re.search(pattern, s["heading"])), None)

    def field_map(self) -> dict[str, str]:
        out: dict[str, str] = {}
        for k, v in self.fields.pairs:
            out.setdefault(k, plain(v))
        return out

    def record(self, kind: str, own: dict) -> dict:
        """What every record holds, then the kind's own facts."""
        first = self.sources[0] if self.sources else {"book": None, "page": None, "source_id": None}
        return {
            "_type": kind, "url": self.url, "name": self.title["name"], "rarity": self.traits["rarity"], "pfs": self.title["pfs"], "legacy": self.title["legacy"], "alt_edition_url": self.title["alt_edition_url"],
            "traits": self.traits["traits"], "source": {k: first[k] for k in ("book", "page", "source_id")}, "raw_fields": self.field_map(), "links": links(self.body) or self.links,
            "body_text": plain(self.body), "body_html": self.body.strip(), "sections": [{k: s[k] for k in ("heading", "level", "body_text")} for s in self.sections],
        } | own

    def read(self, table: list[tuple]) -> dict:
        """The facts that a table names: (field, labels, reader), the reader of the text or ``None`` for the text itself."""
        return {name: (reader or said)(self.fields.text(*names)) for name, names, reader in table}


# Readers of values.


def coins(text: str | None) -> dict:
    """A price as gp, sp and cp."""
    if said(text) is None:
        return {"gp": None, "sp": None, "cp": None, "raw": None}
    found = {unit.lower(): int(n.replace(",", "")) for n, unit in re.findall(r"(?i)([\d,]*\d)\s*(gp|sp|cp)\b", text or "")}
    return {unit: found.get(unit) for unit in ("gp", "sp", "cp")} | {"raw": said(text)}


def bulk(text: str | None) -> str | int | None:
    return "L" if said(text) and said(text).upper() == "L" else None if said(text) is None else number(text)


def damage(text: str | None) -> dict | None:
    """Dice, the letter of the kind, and what comes with it."""
    m = re.match(r"(\d+d\d+(?:\s*[+-]\s*\d+)?)\s*([BPSbps](?![a-z]))?\s*(.*)$", said(text) or "")
    return {"dice": re.sub(r"\s", "", m[1]), "type": m[2].upper() if m[2] else None, "rider": m[3].strip() or None} if m else None


def feet(text: str | None) -> dict | None:
    m = re.search(r"(\d+)\s*feet", text or "")
    return {"feet": int(m[1])} if m else None


def choice(*known: str):  # noqa: ANN201
    """A reader of one word out of some."""
    return lambda text: (text or "").strip().lower() if (text or "").strip().lower() in known else None


def amounts(text: str | None) -> list[dict]:
    """``type N`` pairs; what is excepted stands in brackets."""
    out = []
    for part in listed(text):
        if m := re.match(r"(.*?)\s+(\d+)\s*(?:\(([^)]*)\))?\s*$", part):
            excepted = re.sub(r"(?i)^except\s*", "", m[3]).strip() if m[3] and "except" in m[3].lower() else None
            out.append({"type": m[1].strip(), "value": int(m[2]), "exceptions": excepted})
    return out


def bracketed(text: str | None) -> tuple[int | None, str | None]:
    """A number and the remark in brackets behind it."""
    m = re.match(r"\s*(-?\d+)\s*(?:\(([^)]+)\))?", text or "")
    return (int(m[1]), m[2].strip() if m[2] else None) if m else (None, None)


def stages(fragment: str) -> list[dict]:
    """``Stage N`` entries: text, and the duration that closes it in brackets."""
    marks = list(re.finditer(r"(?i)<b>\s*Stage\s+(\d+)\s*</b>", fragment))
    out = []
    for m, end in zip(marks, [*(x.start() for x in marks[1:]), len(fragment)]):
        text = plain(re.split(r"(?i)<hr\s*/?>", fragment[m.end() : end])[0]).strip(" ;")
        closing = re.search(r"\(([^()]+)\)\s*[;.]?\s*$", text)
        out.append({"stage": int(m[1]), "text": text[: closing.start()].strip(" ;.") if closing else text, "duration": closing[1].strip() if closing else None})
    return out


def outcomes(fragment: str) -> dict:
    """What happens at each degree of success."""
    stop = r"<b>\s*(?:Critical\s+Success|Success|Failure|Critical\s+Failure|Heightened)\b|<hr\s*/?>|$"
    return {name.replace(" ", "_"): after(fragment, name.title().replace(" ", r"\s+"), stop) for name in OUTCOMES}


def save_of(text: str | None) -> dict | None:
    """DC, save and whether it is a basic one."""
    dc = re.search(r"DC\s+(\d+)", text or "")
    kind = re.search(r"(?i)\b(fortitude|reflex|will)\b", text or "")
    return {"dc": int(dc[1]), "save": SAVES[kind[1].lower()] if kind else None, "basic": bool(re.search(r"(?i)\bbasic\b", text or ""))} if dc else None


# Stat blocks.


def strikes(fragment: str) -> list[dict]:
    """Melee and ranged strikes: action, weapon, bonuses, traits, damage, effects."""
    out = []
    for inner in indented(fragment):
        kind = re.match(r"(?i)\s*<b>\s*(Melee|Ranged)\s*</b>", inner)
        if not kind:
            continue
        head, _, tail = re.sub(r"(?i)<b>\s*Damage\s*</b>", "\0", inner[kind.end() :]).partition("\0")
        line = plain(unglyphed(head))
        m = re.match(r"(.*?)\s*([+-]\d+)\s*(?:\[([^\]]*)\])?\s*(?:\(([^)]*)\))?\s*,?\s*$", line)
        more = re.findall(r"[+-]?\d+", m[3]) if m and m[3] else []
        hurt, rest = [], []
        for part in filter(None, (p.strip() for p in re.split(r"\s+plus\s+", plain(tail).rstrip(",; ")))):
            lasting = re.match(r"(?i)persistent\s+", part)
            dice = re.match(r"(\d+d\d+(?:[+-]\d+)?)\s+(.+)$", part[lasting.end() :] if lasting else part)
            if dice:
                hurt.append({"dice": dice[1], "type": dice[2].strip(), "persistent": bool(lasting)})
            else:
                rest.append(part)
        out.append({
            "kind": kind[1].lower(), "action": glyph(inner), "weapon": m[1].strip() if m else line, "attack_bonus": int(m[2]) if m else None, "map_bonuses": [int(x) for x in more[:2]] if len(more) >= 2 else None,
            "traits": listed(m[4]) if m else [], "damage": hurt, "effects": "; ".join(rest) or None,
        })
    return out


def indented(fragment: str) -> list[str]:
    """The inner HTML of the outermost hanging-indent spans."""
    out, at = [], 0
    for m in re.finditer(r"""(?i)<span\s+class=['"]hanging-indent['"][^>]*>""", fragment):
        if m.start() >= at:
            inner = element(fragment, m.start(), "span")
            out.append(inner)
            at = m.end() + len(inner)
    return out


SPELL_LIST = re.compile(r"(Innate Spells|Focus Spells|Rituals|Spells)$", re.IGNORECASE)


def spell_lists(fragment: str) -> list[dict]:
    """Spells by rank under labels such as ``Arcane Innate Spells``."""
    out = []
    for line in re.split(r"(?i)<br\s*/?>", fragment):
        pairs = [(m[1].removesuffix(":").strip(), m.end(), m.start()) for m in re.finditer(r"(?i)<b>\s*([^<]+?)\s*</b>", line)]
        own: dict | None = None
        for (label, start, _), end in zip(pairs, [*(p[2] for p in pairs[1:]), len(line)]):
            text = plain(line[start:end]).strip(" ;,")
            if kind := SPELL_LIST.search(label):
                dc, attack = re.search(r"DC\s+(\d+)", text), re.search(r"(?i)attack\s+([+-]\d+)", text)
                own = {"tradition": label[: kind.start()].strip() or None, "kind": kind[1].lower().split()[0], "dc": int(dc[1]) if dc else None, "attack": int(attack[1]) if attack else None, "slots": []}
                out.append(own)
            elif label.lower() in STAT_LABELS:
                own = None
            elif own is not None:
                entries = []
                for part in listed(text):
                    m = re.match(r"(.*?)(?:\s*\(([^)]+)\))?\s*$", part)
                    times = re.match(r"(?i)[x×]\s*(\d+)$", m[2] or "")
                    entries.append({"name": m[1].strip(), "frequency": m[2], "count": int(times[1]) if times else None})
                own["slots"].append({"rank": label, "spells": entries})
    return out


def abilities(fragment: str) -> list[dict]:
    """Hanging-indent entries that are neither strikes nor plain statistics."""
    out = []
    for inner in indented(fragment):
        m = re.search(r"(?is)<b>\s*(.*?)\s*</b>", inner)
        name = plain(m[1]) if m else ""
        if not name or name.lower() in STAT_LABELS or re.match(r"(?i)stage\s+\d+$", name) or SPELL_LIST.search(name):
            continue
        rest = unglyphed(inner[m.end() :])
        lead = re.match(r"\s*\(([^)]*)\)", plain(rest))
        out.append({
            "name": name, "actions": glyph(inner), "traits": listed(lead[1]) if lead else [], **{k: after(rest, k.title()) for k in ("frequency", "trigger", "requirements", "effect")},
            "saving_throw": save_of(after(rest, "Saving Throw")), "stages": stages(rest), "body_text": plain(inner),
        })
    return out


def monster(p: Page) -> dict:
    defence, _, offence = re.sub(r"(?i)<hr\s*/?>", "\0", p.body).partition("\0")
    d, o, f = Labels(defence), Labels(offence), p.fields
    recall, perception, speech = f.text("Recall Knowledge"), f.text("Perception"), f.text("Languages")
    lores = [{"trait": m[1].strip(), "skill": m[2].strip()} for part in listed("•".join((recall or "").split("•")[1:])) if (m := re.match(r"([^(]+)\(([^)]+)\)", part))]
    skills = []
    for part in listed(f.text("Skills")):
        if m := re.match(r"([^+\-(]+?)\s*([+-]\d+)\s*(?:\(([^)]*)\))?", part):
            more = re.search(r"([+-]\d+)\s*(.*)", m[3] or "")
            skills.append({"name": m[1].strip(), "modifier": int(m[2]), "conditionals": [{"bonus": int(more[1]), "context": more[2].strip()}] if more else []})
    scores = {a: number(f.text(a.title())) for a in ABILITIES}
    spoken, _, special = (speech or "").partition(";")
    ac, condition = bracketed(d.text("AC"))
    hp, regeneration = bracketed(d.text("HP"))
    note = re.search(r"(?i)<b>\s*Will\s*</b>\s*[+-]?\d+\s*;\s*([^<+]+?)\s*(?=<|$)", defence)
    ways: dict = dict.fromkeys(("walk", "burrow", "climb", "fly", "swim"))
    others = []
    for part in listed(o.text("Speed")):
        m = re.match(r"(?i)(?:(burrow|climb|fly|swim)\s+)?(\d+)\s*feet$", part)
        if m:
            ways[(m[1] or "walk").lower()] = int(m[2])
        else:
            others.append(part)
    told = {p.traits["size"], p.traits["alignment"], p.traits["rarity"].title()}
    kinds = {"elite": "elite", "normal": "normal", "weak": "weak"}
    variants = [{"kind": kinds[plain(m[2]).lower()], "url": m[1]} for h in re.findall(r"(?is)<h2[^>]*hide-on-print[^>]*>(.*?)</h2>", p.span) for m in re.finditer(r'(?is)<a[^>]*href="([^"]+)"[^>]*>(.*?)</a>', h) if plain(m[2]).lower() in kinds]
    variants += [{"kind": "pwl", "url": m[1] or m[2]} for m in re.finditer(r"""(?i)<a[^>]*href="([^"]+)"[^>]*monster-pwl-link|<a[^>]*monster-pwl-link[^>]*href="([^"]+)""", p.span)]
    return {
        "level": p.title["level"], "size": p.traits["size"], "alignment": p.traits["alignment"], "traits": [t for t in p.traits["traits"] if t not in told],
        "recall_knowledge": {"dc": number(recall), "lores": lores, "raw": recall},
        "perception": {"modifier": number((perception or "").split(";")[0]), "senses": listed(";".join((perception or "").split(";")[1:])), "raw": perception},
        "languages": {"languages": [] if re.match(r"(?i)\s*none\b", spoken) else listed(spoken), "special": listed(special), "raw": speech},
        "skills": skills, "abilities": scores, "items": listed(f.text("Items")), "ac": {"value": ac, "conditional": condition, "saves_note": note[1].strip() if note else None},
        "saves": {s: number(d.text(s.title())) for s in ("fort", "ref", "will")}, "hp": {"value": hp, "special": regeneration}, "hardness": number(d.text("Hardness")),
        "immunities": listed(d.text("Immunities")), "weaknesses": [{k: x[k] for k in ("type", "value")} for x in amounts(d.text("Weaknesses"))], "resistances": amounts(d.text("Resistances")),
        "speed": ways | {"special": "; ".join(others) or None}, "strikes": strikes(offence), "spell_lists": spell_lists(p.head) + spell_lists(offence),
        "top_abilities": abilities(p.head), "defensive_abilities": abilities(defence), "offensive_abilities": abilities(offence), "variants": variants,
    }


# Spells.


def affliction(fragment: str) -> dict | None:
    """An affliction inside a body: kind, level, save, onset, longest duration, stages."""
    for m in re.finditer(r"(?is)<b>\s*([^<]+?)\s*</b>\s*\(([^)]+)\)\s*;\s*(?=<b>\s*Level\s*</b>)", fragment):
        if any(a in m[2].lower() for a in AFFLICTIONS):
            block = re.split(r"(?i)<b>\s*(?:Critical\s+Success|Success|Failure|Critical\s+Failure|Heightened)\b", fragment[m.end() :])[0]
            return {"name": m[1].strip(), "type": m[2].lower().strip(), "level": number(after(block, "Level")), "saving_throw": after(block, r"Saving\s+Throw"), "onset": after(block, "Onset"), "maximum_duration": after(block, r"Maximum\s+Duration"), "stages": stages(block), "at": m.start()}
    return None


def heightened(p: Page) -> list[dict]:
    """Entries for higher ranks: a rank, or an increment."""
    marks = list(re.finditer(r"(?i)<b>\s*Heightened\s*\(([^)]+)\)\s*</b>", p.body))
    found = [(m[1].strip(), p.body[m.end() : end]) for m, end in zip(marks, [*(x.start() for x in marks[1:]), len(p.body)])]
    found = found or [(re.sub(r"(?i)^heightened\s*\(?|\)$", "", k).strip(), v) for k, v in p.fields.pairs if k.lower().startswith("heightened")]
    return [{"rank_label": k, "rank": None if k.startswith("+") else number(k), "increment": number(k) if k.startswith("+") else None, "body_text": plain(v)} for k, v in found]


def spell(p: Page) -> dict:
    kind = (p.title["level_kind"] or "").lower()
    cast, save = p.fields.html("Cast"), p.fields.text("Saving Throw")
    parts = [plain(m).lower() for m in re.findall(r"""(?is)<a[^>]*Rules\.aspx\?ID=\d+[^>]*>(.*?)</a>""", cast or "") if plain(m)]
    left = re.sub(r"\[[a-z-]+\]", "", plain(unglyphed(cast or "")))
    for part in parts:
        left = re.sub(rf"(?i)\b{re.escape(part)}\b", "", left)
    found = affliction(p.body)
    ends = [m.start() for m in re.finditer(r"(?i)<b>\s*(?:Critical\s+Success|Success|Failure|Critical\s+Failure|Heightened)\b", p.body)][:1] + ([found.pop("at")] if found else [])
    text = p.body[: min(ends, default=len(p.body))]
    ritual = p.url.lower().find("ritual") >= 0
    return {
        "kind": kind if kind in ("cantrip", "focus", "ritual") else "ritual" if ritual else "spell", "rank": p.title["level"], "action_cost": p.title["action_cost"],
        "traditions": [t for t in (x.lower() for x in listed(p.fields.text("Traditions", "Tradition"))) if t in TRADITIONS], "spell_list": p.fields.text("Spell List"),
        "bloodlines": named(p.fields.html("Bloodline", "Bloodlines"), "bloodline_id"), "cult": named(p.fields.html("Cult", "Cults"), "cult_id"), "domain": named(p.fields.html("Domain", "Domains"), "domain_id"),
        "cast": {"actions": glyph(cast or ""), "components": parts, "time": " ".join(re.sub(r"[,;]+", " ", left).split()) or None, "raw": plain(cast) or None},
        "saving_throw": {"kind": re.sub(r"(?i)^basic\s+", "", save).strip() or None, "basic": bool(re.match(r"(?i)basic\b", save)), "raw": save} if save else None,
        "description_text": plain(text), "outcomes": outcomes(p.body), "affliction": found, "heightened": heightened(p),
    } | {k: p.fields.text(k.title()) for k in ("trigger", "range", "area", "targets", "duration", "cost", "requirements")}


# Equipment.


def before_sections(fragment: str) -> str:
    return re.split(r"""(?i)<h2\s+class=["']title""", fragment)[0]


def group(fragment: str | None, kind: str) -> dict | None:
    if said(plain(fragment)) is None:
        return None
    own = next((x for x in links(fragment or "") if x["kind"] == kind), None)
    return {"name": own["text"], "group_id": own["id"]} if own else {"name": plain(fragment), "group_id": None}


def glossary(span: str) -> list[dict]:
    """Trait entries with what they mean."""
    return [{"trait": k, "description": plain(v)} for m in re.finditer(r"""(?i)<div[^>]*class=['"]trait-entry['"]""", span) for k, v in labelled(element(span, m.start(), "div"))[:1]]


def weapon(p: Page) -> dict:
    special = p.section(r"(?i)^Critical Specialization Effects$")
    told = Labels(special["body_html"].replace("</b>:", "</b>")) if special else None
    by_group = {k: plain(v).lstrip(": ") for k, v in reversed(told.pairs) if k.lower() != "source"} if told else {}
    magic = p.section(r"(?i)^Specific Magic Weapons$")
    return p.read([
        ("price", ("Price",), coins), ("damage", ("Damage",), damage), ("bulk", ("Bulk",), bulk), ("hands", ("Hands",), lambda t: (t or "").replace(" ", "") if (t or "").replace(" ", "") in ("1", "2", "1+") else None),
        ("reload", ("Reload",), None), ("range", ("Range",), feet), ("ammunition", ("Ammunition",), None), ("weapon_type", ("Type",), choice("melee", "ranged")), ("category", ("Category",), choice("unarmed", "simple", "martial", "advanced")),
    ]) | {
        "favored_weapon": [{"deity": x["text"], "deity_id": x["id"]} for x in links(p.fields.html("Favored Weapon") or "") if x["kind"] == "Deities" and x["text"]], "group": group(p.fields.html("Group"), "WeaponGroups"),
        "description_text": plain(before_sections(p.body)), "critical_specialization": {"source": (sources(special["body_html"]) or [{"book": None}])[0]["book"], "by_group": by_group} if special else None,
        "specific_magic_weapons": named(magic["body_html"], "equipment_id", "Equipment") if magic else [], "trait_glossary": glossary(p.span),
    }


def armor(p: Page) -> dict:
    whole = lambda t: number(said(t))
    return p.read([
        ("price", ("Price",), coins), ("bulk", ("Bulk",), bulk), ("category", ("Category",), choice("unarmored", "light", "medium", "heavy")),
        *[(k, (k.replace("_", " ").title().replace("Ac ", "AC "),), whole) for k in ("ac_bonus", "dex_cap", "check_penalty", "speed_penalty", "strength")],
    ]) | {"group": group(p.fields.html("Group"), "ArmorGroups"), "description_text": plain(before_sections(p.body))}


def activation(fragment: str) -> dict:
    """An ``Activate`` line: glyphs, components in brackets, and the rest."""
    costs = [ACTIONS[g.lower()] for g in re.findall(r"""(?is)<span\s+class=['"]action['"][^>]*>\s*\[([a-z-]+)\]""", fragment) if g.lower() in ACTIONS]
    rest = plain(unglyphed(fragment))
    inside = re.search(r"\(([^()]+)\)", rest)
    return {"action_cost": None if not costs else costs[0] if len(costs) == 1 else "variable", "components": [x.lower() for x in listed(inside[1])] if inside else [], "text": " ".join(re.sub(r"\([^()]*\)", "", rest).split()) or None}


def equipment(p: Page) -> dict:
    loose = ("frequency", "trigger", "requirements", "effect", "onset", "duration", "craft_requirements", "access", "benefit", "drawback", "cost", "saving_throw")
    label = lambda k: k.replace("_", " ").title()
    variants = []
    for s in p.sections:
        if re.search(r"(?i)\((Lesser|Moderate|Greater|Major)\)", s["heading"]):
            own, level = Labels(s["body_html"]), re.search(r"(?i)Item\s+(-?\d+)", s["heading"])
            first = (sources(s["body_html"]) or [{"book": None, "page": None, "source_id": None}])[0]
            rest = re.sub(r"(?is)<b>\s*(?:Source|Price|Bulk)\s*</b>.*?<br\s*/?>", "", s["body_html"])
            variants.append({
                "name": re.sub(r"(?i)\s*Item\s+-?\d+\+?", "", s["heading"]).strip(), "item_level": int(level[1]) if level else None, "source": {k: first[k] for k in ("book", "page", "source_id")},
                "price": coins(own.text("Price")), "bulk": bulk(own.text("Bulk")), "description_text": plain(rest),
            })
    text = re.sub(rf"(?is)<b>\s*(?:{'|'.join(map(label, loose))}|Activate|Usage|Hands)\s*</b>.*?(?=<b>|<h2|<h3|$)", "", before_sections(p.body))
    return p.read([("price", ("Price",), coins), ("bulk", ("Bulk",), bulk), ("usage", ("Usage",), None), ("hands", ("Hands",), None)]) | {
        "item_level": p.title["level"], "tiered_variants": p.title["tiered"], "activations": [activation(v) for k, v in p.fields.pairs if k.lower() == "activate"],
        **{k: said(p.fields.text(label(k))) or after(p.body, label(k)) for k in loose}, "description_text": plain(text), "variants": variants,
    }


# The other kinds.


def feat(p: Page) -> dict:
    leads = p.section(r"(?i)Leads To\.{2,3}\s*$")
    texts = [(n, (n.title(),), None) for n in ("frequency", "trigger", "requirements", "cost", "access")]
    return p.read([("prerequisites", ("Prerequisites", "Prerequisite"), None), *texts]) | {
        "level": p.title["level"], "action_cost": p.title["action_cost"], "archetypes": named(p.fields.html("Archetype", "Archetypes"), "archetype_id", "Archetypes"),
        "archetype_footnotes": [t[1:].strip() for t in map(plain, re.split(r"(?i)<br\s*/?>", p.head)) if t.startswith("*") and t[1:].strip()], "special": after(p.body, "Special"),
        "description_text": plain(re.sub(r"(?is)<b>\s*Special\s*</b>.*?(?=<b>|<h2|<h3|$)", "", before_sections(p.body))), "leads_to": named(leads["body_html"], "feat_id", "Feats") if leads else [], "trait_glossary": glossary(p.span),
    }


def action(p: Page) -> dict:
    return p.read([(n, (n.title(),), None) for n in ("trigger", "frequency", "requirements", "cost")]) | {"action_cost": p.title["action_cost"], "effect_text": plain(before_sections(p.body)), "outcomes": outcomes(re.split(r"(?i)<hr\s*/?>", p.body)[0])}


def ancestry(p: Page) -> dict:
    f, beliefs = p.fields, p.section(r"(?i)Beliefs")
    spoken = listed(f.text("Languages"))
    chosen = [x for x in spoken if re.search(r"(?i)intelligence|bonus|additional|number you can speak|chose", x)]
    about = beliefs["body_html"] if beliefs else p.body
    return {
        "mechanics": {
            "hit_points": number(f.text("Hit Points")), "size": p.traits["size"] or f.text("Size"), "speed": number(f.text("Speed")), "attribute_boosts": listed(f.text("Attribute Boosts", "Ability Boosts")),
            "attribute_flaws": listed(f.text("Attribute Flaw", "Attribute Flaws", "Ability Flaws", "Ability Flaw")), "languages": {"fixed": [x for x in spoken if x not in chosen], "bonus_choice": chosen, "raw": f.text("Languages")},
            "vision": next((s["heading"] for s in p.sections if "vision" in s["heading"].lower()), None), "granted": [s["heading"] for s in p.sections if re.match(r"(?i)Clan Dagger|Granted|Heritage", s["heading"])],
        },
        "popular_edicts": after(about, "Popular Edicts"), "popular_anathema": after(about, "Popular Anathema"),
    }


def character_class(p: Page) -> dict:
    skills = p.section(r"(?i)Initial Proficiencies")
    found = {k: plain(v) for k, v in reversed(Labels(skills["body_html"]).pairs)} if skills else {}
    return {
        "key_attribute": p.fields.text("Key Attribute", "Key Ability"), "hit_points_text": p.fields.text("Hit Points"), "hp_per_level": number(p.fields.text("Hit Points")), "class_dc": p.fields.text("Class DC"),
        "initial_proficiencies": found, "subclasses": [{"name": s["heading"], "description": s["body_text"]} for s in p.sections if s["level"] == 3 and re.search(r"(?i)research field|methodology", s["body_text"])],
    }


def background(p: Page) -> dict:
    text = plain(p.body)
    boost, cut = re.search(r"must be to ([A-Z][a-z]+)(?: or ([A-Z][a-z]+))?", text), re.search(r"(?i)Choose (?:two|an) attribute", text)
    skills = [{"name": x["text"], "skill_id": x["id"]} for x in p.links if x["kind"] == "Skills"]
    granted = next((x for x in p.links if x["kind"] == "Feats"), None)
    return {
        "attribute_boost_choice": {"fixed_options": [a for a in boost.groups() if a in ATTRIBUTES], "free": "free attribute boost" in text.lower()} if boost else None,
        "trained_skills": [s for s in skills if "lore" not in s["name"].lower()], "lore_skills": [s for s in skills if "lore" in s["name"].lower()],
        "granted_feat": {"name": granted["text"], "feat_id": granted["id"]} if granted else None, "flavor_text": text[: cut.start()].strip() if cut else text,
    }


def condition(p: Page) -> dict:
    return {"stages": stages(p.body), "related_conditions": [{"name": x["text"], "condition_id": x["id"]} for x in p.links if x["kind"] == "Conditions"]}


def trait(p: Page) -> dict:
    kinds = {x["kind"] for x in p.links}
    return {"category": "spell" if "Spells" in kinds else "weapon" if "Weapons" in kinds else "creature" if kinds & {"Monsters", "Creatures"} else None}


def hazard(p: Page) -> dict:
    f = p.fields
    hidden = re.search(r"(?i)DC\s*(\d+)\s*(.*)", f.text("Stealth") or "")
    disable = []
    for part in filter(None, re.split(r",\s*or\s+|;\s*", f.text("Disable") or "")):
        m = re.search(r"DC\s*(\d+)\s+([A-Z][a-zA-Z\s]+?)(?:\s*\(|\s+to\s|$)", part)
        disable.append({"skill": m[2].strip() if m else "", "dc": int(m[1]) if m else None, "text": part.strip()})

    def components(suffix: str) -> list[dict]:
        out = []
        for k, v in f.pairs:
            if (m := re.match(rf"(?i)(.*?)\s*{suffix}$", k)) and number(plain(v)) is not None:
                broken, note = re.search(r"(?i)\(BT\s*(\d+)\)", plain(v)), re.search(r"\((.*?)\)", plain(v))
                out.append({"component": m[1].strip() or "main", "value": number(plain(v)), "bt": int(broken[1]) if broken else None, "notes": note[1].strip() if note and not broken else None})
        return out

    known, routines = {"Complexity", "Stealth", "Description", "Disable", "AC", "Fort", "Ref", "Will", "Immunities", "Weaknesses", "Resistances", "Reset", "Routine"}, []
    for k, v in f.pairs:
        if k in ("Trigger", "Effect") and routines:
            routines[-1][k.lower()] = plain(v)
        elif k not in known | {"Trigger", "Effect"} and not re.search(r"Hardness$|\bHP$", k):
            routines.append({"name": k, "trigger": None, "effect": plain(v), "actions": glyph(v)})
    return {
        "level": p.title["level"], "complexity": choice("simple", "complex")(f.text("Complexity")), "stealth": {"dc": int(hidden[1]) if hidden else None, "notes": (hidden[2].strip() or None) if hidden else f.text("Stealth"), "raw": f.text("Stealth")},
        "description_text": f.text("Description"), "disable": disable, "routines": routines, "reset": f.text("Reset"),
        "defenses": {
            "ac": number(f.text("AC")), "saves": {s: number(f.text(s.title())) for s in ("fort", "ref", "will")}, "hardness": components("Hardness"), "hp": components("HP"), "immunities": listed(f.text("Immunities")),
            "weaknesses": [{k: x[k] for k in ("type", "value")} for x in amounts(f.text("Weaknesses"))], "resistances": amounts(f.text("Resistances")),
        },
    }


def generic(p: Page) -> dict:
    return {"level": p.title["level"], "level_kind": p.title["level_kind"]}


READERS = {
    "spell": ("spell", spell), "ritual": ("spell", spell), "monster": ("monster", monster), "feat": ("feat", feat), "weapon": ("weapon", weapon), "armor": ("armor", armor), "shield": ("armor", armor),
    "equipment": ("equipment", equipment), "action": ("action", action), "ancestry": ("ancestry", ancestry), "class": ("class", character_class), "background": ("background", background),
    "condition": ("condition", condition), "trait": ("trait", trait), "hazard": ("hazard", hazard),
}


def page_kind(url: str) -> str:
    """As ``extract.page_type`` has it."""
    m = re.search(r"/([A-Za-z]+)\.aspx", url or "")
    return PAGE_TYPES.get(m[1].lower(), "generic") if m else "unknown"


def page_record(page: str | None, url: str | None) -> dict:
    """The record of a page by the kind its address names; ``unknown`` without a titled span."""
    span = content(page or "")
    if span is None:
        return {"_type": "unknown", "url": url, "name": "", "rarity": "common", "traits": [], "links": [], "raw_fields": {}, "body_text": "", "sections": []}
    own = Page(span, page or "", url or "")
    kind, reader = READERS.get(page_kind(url or ""), ("generic", generic))
    return own.record(kind, reader(own))


# Pages whose class is told by their address, and by the type of their record.
CLASS_PAGES = "Feats Spells Monsters MonsterFamilies Actions Weapons Armor Equipment Ancestries Classes Backgrounds Conditions Traits Hazards".split()
CLASS_NAMES = "Feat Spell Monster MonsterFamily Action Weapon Armor Equipment Ancestry Class Background Condition Trait Hazard".split()


def class_rules() -> dict:
    """The cascade's configuration for these records: type first, then address, then structure."""
    typed = [c for c in CLASS_NAMES if c != "MonsterFamily"]
    structural = [{"className": c, "priority": 20, "predicate": {"path": "/_type", "equals": c.lower()}, "reasons": [f"_type={c.lower()}"]} for c in typed]
    structural.append({"className": "Generic", "priority": 10, "predicate": {"path": "/_type", "equals": "generic"}, "reasons": ["_type=generic"]})
    return {
        "discriminator": {"from": "/_type", "sanitize": "pascalCase", "priority": 80}, "onConflict": "pickPriority", "evidence": True, "structural": structural,
        "urlPattern": [{"className": c, "match": f"/{p}\\.aspx", "priority": 35} for p, c in zip(CLASS_PAGES, CLASS_NAMES)],
    }


# Wikitext.

# Template (the beginning of its name, in lower case) or title pattern, type of the record, and its fields
# with the template arguments they come from (the first that is there; "#" reads a number, "*" a list of all).
WIKI_TEMPLATES = [
    (("pokémon infobox", "pokemon infobox"), "pokemon", "ndex=#ndex name jname types=*type1,type2 category height_m=#height-m weight_kg=#weight-kg abilities=*ability1,ability2,abilityd egg_groups=*egggroup1,egggroup2 egg_cycles=#eggcycles color catch_rate=#catchrate generation"),
    (("moveinfobox",), "move", "move_number=#n name jname type damage_category=damagecategory base_pp=#basepp power=#power accuracy=#accuracy generation=gen"),
    (("iteminfobox/head",), "item", "name jname generation=gen"),
    (("mastersinfobox",), "masters", "name jname jtrans type num desc enva java image caption"),
    (("mastersskillinfobox",), "masters_skill", "name"),
    (("masterseventinfobox",), "masters_event", "name"),
    (("pokémoncardinfobox",), "tcg_pokemon_card", "name=cardname jname species stage=evostage card_type=type hp=#hp weakness resistance retreat_cost=#retreatcost"),
    (("tcgtrainercardinfobox",), "tcg_trainer_card", "name=cardname jname card_class=class"),
    (("tcgexpansioninfobox",), "tcg_set", "name=setname ja_name=jasetname translated_name=transsetname en_card_count=#encards en_set_number=#ensetnum en_release=enrelease ja_card_count=#jacards ja_release=jarelease"),
    (("deckinfobox",), "tcg_deck", "name"),
    (("tcgpromoinfobox",), "tcg_promo", "name"),
    (("town infobox",), "location", "name ja_name=jpname region generation"),
    (("route infobox",), "location", "name ja_name=jpname region generation"),
    (("infobox location",), "location", "name ja_name=jpname region generation"),
    (("animelocationinfobox",), "location", "name ja_name=jpname region generation"),
    (("character infobox", "charinfobox"), "character", "name jname"),
    (("trainerclassinfobox",), "trainer_class", "name ja_name=jpname"),
    (("uniteinfobox",), "unite_pokemon", "pokemon jname role range damage difficulty"),
    (("tcgenergycardinfobox",), "tcg_energy_card", "name=cardname energy_type=energy,type"),
    (("infobox game",), "game", "name jname platform developer publisher release_ja=release_date_ja,releaseja release_us=release_date_us,releaseus"),
]
LOCATION_KINDS = {"town infobox": "city", "route infobox": "route", "infobox location": "location", "animelocationinfobox": "anime"}
WIKI_TITLES = [(r"/Generation ([IVX]+) learnset$", "learnset_data"), (r" cards$", "card_list"), (r"/\w+ anime history$", "anime_history"), (r"/(?:moves|base stats)$", "game_data")]


def reference(value: str) -> str | None:
    """What a template or link stands for: its first argument or text; tooltips show their first part."""
    value = re.sub(r"(?i)\{\{tt\|([^|}\n]+)\|[^}]*\}\}", r"\1", value).strip()
    for pattern in (r"\{\{[^|}\n]+\|([^|}\n]+)[^}]*\}\}", r"\[\[[^\]|]+\|([^\]]+)\]\]", r"\[\[([^\]]+)\]\]"):
        if m := re.search(pattern, value):
            return m[1].strip() or None
    return value or None


def _fields(spec: str, arguments: dict[str, str]) -> dict:
    out: dict = {}
    for part in spec.split():
        name, _, origin = part.partition("=")
        origin = origin or name
        kind, keys = (origin[0], origin[1:]) if origin[0] in "#*" else ("", origin)
        values = [v for k in keys.split(",") if (v := reference(arguments.get(k, ""))) is not None]
        if kind == "*":
            out[name] = values
        elif kind == "#":
            m = re.match(r"\s*-?\d+(?:\.\d+)?", values[0]) if values else None
            out[name] = (float(m[0]) if "." in m[0] else int(m[0])) if m else None
        else:
            out[name] = values[0] if values else None
    return out


def wiki_record(name: str, wikitext: str | None) -> dict | None:
    """The record of a wikitext page, NULL for empty pages and redirects."""
    if not wikitext or wikitext.strip().startswith("#REDIRECT"):
        return None
    found = [{"name": t["name"].lower(), "arguments": {k.lower(): v for k, v in t["arguments"].items()}} for t in templates(wikitext)]
    categories = [m.strip() for m in re.findall(r"(?i)\[\[Category:([^|\]]+)", wikitext)]
    base = {"title": name, "categories": categories}
    for names, kind, spec in WIKI_TEMPLATES:
        own = next((t for t in found if any(t["name"].startswith(n) for n in names)), None)
        if own is None:
            continue
        out = {"_type": kind} | base | _fields(spec, own["arguments"])
        if kind == "location":
            out["location_type"] = LOCATION_KINDS[names[0]]
        if kind in ("tcg_pokemon_card", "tcg_trainer_card"):
            cards = [t for t in found if t["name"].startswith(f"{names[0]}/expansion")]
            out["expansions"] = [_fields("expansion card_number=cardno,jpcardno rarity=rarity,jprarity", t["arguments"]) for t in cards]
        return out
    for pattern, kind in WIKI_TITLES:
        if m := re.search(pattern, name):
            more = {"pokemon": name.split("/")[0], "generation": m[1]} if kind == "learnset_data" else {"subject": name.removesuffix(" cards")} if kind == "card_list" else {}
            return {"_type": kind} | base | more
    return {"_type": "unknown"} | base


# Columns.


def _json(make):  # noqa: ANN001, ANN202
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if (found := make(x, y)) is None else json.dumps(found, ensure_ascii=False) for x, y in zip(a, b)], dtype=object)

    return F.pandas_udf(run, "string")


def page_column(page: Column, url: Column) -> Column:
    """The record of each page as a VARIANT."""
    return F.try_parse_json(_json(page_record)(page, url))


def wiki_column(name: Column, wikitext: Column) -> Column:
    """The record of each wikitext page as a VARIANT."""
    return F.try_parse_json(_json(wiki_record)(name, wikitext))


def page_records(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``rec``, ready for the cascade with ``class_rules``."""
    return pages.withColumn("rec", page_column(F.col(html), F.col(url)))
