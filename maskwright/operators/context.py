"""What a model is told about the masks of an image: subject counts, surfaces, selectors, owners and safe phrases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

from .lexicon import PLURAL_SURFACES, REFERENCES, looks_plural, plural, terms

# Words of a phrase that tells like masks apart.
ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth")
REGIONS = {"middle-left": "left-side", "middle-center": "central", "middle-right": "right-side", "upper-center": "upper", "lower-center": "lower"}
FIELDS = ("main_candidate", "object", "source_prompt", "caption")
PERSONS = ("boy", "girl", "man", "woman")


@dataclass
class Mask:
    """A mask with the texts that name it.  `children`: mask ids that make it up."""

    mask_id: str
    main_candidate: str = ""
    object: str = ""
    source_prompt: str = ""
    caption: str = ""
    bbox: tuple[int, int, int, int] = (0, 0, 1, 1)
    components: int = 1
    children: tuple[str, ...] = ()
    expected: frozenset[str] = field(default=frozenset(), init=False)
    source: str = field(default="", init=False)

    def name(self, parser) -> Mask:
        """Takes the expected terms from the first text that has nouns."""
        for f in FIELDS:
            found = terms(parser, getattr(self, f))
            if found:
                self.expected, self.source = frozenset(found), f
                break
        return self

    @property
    def anchor(self) -> str:
        return (self.main_candidate or self.object or self.source_prompt or "").strip()


def suffix(n: int) -> str:
    return "th" if n % 100 in (11, 12, 13) else {1: "st", 2: "nd", 3: "rd"}.get(n % 10, "th")


def selector(index: int, total: int) -> str:
    if total <= 1:
        return ""
    if total == 2 and index in (1, 2):
        return ("one", "the other")[index - 1]
    return f"the {ORDINALS[index - 1]}" if 0 < index <= len(ORDINALS) else f"the {index}{suffix(index)}"


def region(box, width: int, height: int) -> str:
    third = lambda at, size, whole: min(2, int(3 * (at + size / 2) / max(1, whole)))
    return ("upper", "middle", "lower")[third(box[1], box[3], height)] + "-" + ("left", "center", "right")[third(box[0], box[2], width)]


def held(inner, outer) -> float:
    """Part of a box that another holds."""
    side = lambda a, b, i: max(0, min(a[i] + a[i + 2], b[i] + b[i + 2]) - max(a[i], b[i]))
    return side(inner, outer, 0) * side(inner, outer, 1) / max(1.0, inner[2] * inner[3])


def owner_ids(masks: list[Mask], lexicon, least: float = 0.8, rival: float = 0.55, lead: float = 0.2) -> list[int | None]:
    """For body parts the person (place from 1) that owns them, where boxes leave no doubt."""
    people = [i for i, m in enumerate(masks) if lexicon.any_is(m.expected, "person")]
    out: list[int | None] = []
    for i, m in enumerate(masks):
        owner = None
        if lexicon.body_parts(set(m.expected)):
            best = sorted(((held(m.bbox, masks[p].bbox), p) for p in people if p != i), reverse=True)
            if len(people) == 1:
                owner = people[0] + 1
            elif best and best[0][0] >= least:
                second = best[1][0] if len(best) > 1 else 0.0
                owner = best[0][1] + 1 if second <= rival or best[0][0] - second >= lead else None
        out.append(owner)
    return out


def possessive(anchor: str) -> str:
    words = set(re.findall(r"[a-z]+", anchor.lower()))
    return "her" if words & {"woman", "girl"} else "his" if words & {"man", "boy"} else "their"


def subject_key(mask: Mask, lexicon) -> str:
    base = "|".join(sorted(mask.expected)) or mask.anchor.lower()
    if lexicon.any_is(mask.expected, "person"):
        said = set(re.findall(r"[a-z]+", mask.anchor.lower())) & set(PERSONS)
        if len(said) == 1:
            return f"{base}:{said.pop()}"
    return base


def _bare(text: str) -> str:
    return re.sub(r"^(?:a|an|the)\s+", "", re.sub(r"\s+", " ", text.strip().lower()))


def surface(mask: Mask, lexicon, parser, instance: bool) -> str:
    """A short noun phrase that names the mask; of one of several like masks rather the candidate's than the object's."""
    order = ("main_candidate", "object") if instance and _bare(mask.object) not in PLURAL_SURFACES else ("object", "main_candidate")
    for f in order:
        text = _bare(getattr(mask, f))
        if text and len(text.split()) <= 5 and re.fullmatch(r"[a-z0-9]+(?:[- ][a-z0-9]+)*", text) and (not mask.expected or lexicon.fits(mask.expected, terms(parser, text))):
            return text
    return re.sub(r"\s+", " ", (mask.anchor or "object").lower())


def allowed_nouns(mask: Mask, lexicon) -> list[str]:
    words = {w.lower() for w in re.findall(r"[A-Za-z]+", mask.anchor) if len(w) > 1} - set(REFERENCES)
    return sorted(set(mask.expected) | words | {a for e in mask.expected for a in lexicon.alternatives(e)})


def safe_phrase(noun: str, allowed: list[str], index: int, total: int, where: str, spatial: bool) -> str:
    noun = re.sub(r"\s+", " ", noun.strip().lower()) or next(iter(allowed), "object")
    if total > 1 and where and (looks_plural(noun) or spatial):
        return f"the {REGIONS.get(where, where)} {'hairstyle' if noun == 'hair' else noun}"
    pick = selector(index, total)
    return f"{pick} {noun}" if pick else f"the {noun}"


def tagged(link: int, phrase: str, owner: int | None, whose: str) -> str:
    """The phrase in its tags, the owner's possessive tagged inside."""
    own = f"[{owner}]{whose}[/{owner}]"
    if owner is None:
        inner = phrase
    elif phrase.lower().startswith("one "):
        inner = f"one of {own} {plural(phrase[4:])}"
    else:
        inner = f"{own} {re.sub(r'^the\s+', '', phrase, flags=re.I)}"
    return f"[{link}]{inner}[/{link}]"


def relative_names(boxes: list) -> list[str]:
    """Names of boxes by their order along the axis on which their centres lie farther apart."""
    mid = [[b[a] + b[a + 2] / 2 for b in boxes] for a in (0, 1)]
    across = max(mid[0]) - min(mid[0]) >= max(mid[1]) - min(mid[1])
    few = {2: (("upper", "lower"), ("left-side", "right-side")), 3: (("upper", "middle", "lower"), ("left-side", "central", "right-side"))}.get(len(boxes))
    out = [""] * len(boxes)
    for rank, i in enumerate(sorted(range(len(boxes)), key=lambda i: mid[0 if across else 1][i])):
        out[i] = few[across][rank] if few else f"{rank + 1}{suffix(rank + 1)}-from-{'left' if across else 'top'}"
    return out


def mask_context(masks: list[Mask], lexicon, parser, size: tuple[int, int] | None = None) -> list[dict]:
    """One entry a mask, in order.  `size`: width and height of the image; without it the masks' extent."""
    if not masks:
        return []
    width, height = size or (max(1, max(m.bbox[0] + m.bbox[2] for m in masks)), max(1, max(m.bbox[1] + m.bbox[3] for m in masks)))
    place = {m.mask_id: i + 1 for i, m in enumerate(masks)}
    keys, owners = [subject_key(m, lexicon) for m in masks], owner_ids(masks, lexicon)
    totals, owned, seen = Counter(keys), Counter(zip(owners, keys, strict=True)), Counter()
    out = []
    for i, m in enumerate(masks):
        key, owner = keys[i], owners[i]
        seen[key] += 1
        seen[owner, key] += 1
        noun = surface(m, lexicon, parser, totals[key] > 1 and m.components <= 1)
        allowed, where = allowed_nouns(m, lexicon), region(m.bbox, width, height)
        index, total = (seen[key], totals[key]) if owner is None else (seen[owner, key], owned[owner, key])
        phrase = safe_phrase(noun, allowed, index, total, where, owner is None and lexicon.body_parts(set(m.expected)))
        out.append({
            "id": i + 1, "crop_image": i + 3, "bbox_xywh": list(m.bbox), "image_region": where, "same_subject_index": seen[key], "same_subject_total": totals[key], "subject_anchor": m.anchor,
            "surface_identity_noun": noun, "significant_component_count": m.components, "composite_of_ids": [place[c] for c in m.children if c in place], "allowed_identity_nouns": allowed,
            "fallback_unique_selector": selector(seen[key], totals[key]), "safe_tag_phrase": phrase, "required_owner_id": owner, "_key": key,
        })
    alike = defaultdict(list)
    for item in out:
        alike[item["_key"], item["required_owner_id"], item["safe_tag_phrase"].lower()].append(item)
    for items in alike.values():
        if len(items) > 1:
            for item, name in zip(items, relative_names([x["bbox_xywh"] for x in items]), strict=True):
                noun = item["surface_identity_noun"]
                item |= {"fallback_unique_selector": f"the {name}", "safe_tag_phrase": f"the {name} {'hairstyle' if noun == 'hair' else noun}"}
    for item in out:
        owner = item["required_owner_id"]
        item["safe_tagged_phrase"] = tagged(item["id"], item["safe_tag_phrase"], owner, possessive(masks[owner - 1].anchor) if owner else "their")
        del item["_key"]
    by_id = {item["id"]: item["safe_tagged_phrase"] for item in out}
    for item in out:
        if len(item["composite_of_ids"]) > 1:
            *most, last = [by_id[c] for c in item["composite_of_ids"]]
            inner = f"{', '.join(most)}{',' * (len(most) > 1)} and {last}"
            item["safe_tagged_phrase"] = item["composite_link_example"] = f"[{item['id']}]{inner}[/{item['id']}]"
    return out


def model_context(masks: list[Mask], lexicon, parser, size: tuple[int, int] | None = None) -> list[dict]:
    """The context without wording for single instances; like masks (of one owner) name each other instead."""
    every = mask_context(masks, lexicon, parser, size)
    keys = [(subject_key(m, lexicon), item["required_owner_id"]) for m, item in zip(masks, every, strict=True)]
    peers = defaultdict(list)
    for key, item in zip(keys, every, strict=True):
        peers[key].append(item["id"])
    hidden = ("same_subject_index", "fallback_unique_selector", "safe_tag_phrase", "safe_tagged_phrase", "composite_link_example")
    return [{k: v for k, v in item.items() if k not in hidden} | ({"collective_candidate_ids": peers[key]} if len(peers[key]) > 1 else {}) for key, item in zip(keys, every, strict=True)]
