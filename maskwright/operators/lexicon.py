"""Nouns and their senses for the validator: normal forms, one-hop compatibility, categories, and a stand-in for a parser."""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterable

from ..functions.text import IRREGULAR, PLURAL_ONLY, PLURALS
from .taxonomy import GENERIC

# Word lists that decide what a noun is.
PLURAL_SURFACES = ("eyeglasses", "glasses", "goggles", "jeans", "leggings", "pants", "shorts", "sunglasses", "trousers")
CLOTHING = ("shoe", "sneaker", "boot", "sandal", "pants", "trouser", "jean", "shorts", "shirt", "jersey", "blouse", "top", "sweater", "hoodie", "coat", "jacket")
BODY_PARTS = ("arm", "beard", "ear", "eye", "face", "foot", "hair", "hand", "head", "leg", "mouth", "neck", "nose", "shoulder")
REFERENCES = ("he", "her", "hers", "him", "his", "it", "its", "one", "other", "she", "that", "them", "their", "theirs", "they", "this")
PERSON_REFERENCES = ("he", "her", "hers", "him", "his", "she")
COLLECTIVES = ("audience", "band", "bunch", "class", "cluster", "collection", "couple", "crowd", "family", "flock", "group", "herd", "line", "pair", "row", "set", "stack", "team")
STOP = ("a", "an", "and", "are", "as", "at", "by", "for", "from", "in", "is", "of", "on", "or", "the", "to", "was", "were", "with")


BACKGROUND = ("background", "backdrop", "foreground", "scene", "setting", "surrounding", "surroundings")
VIEWS = ("close-up", "closeup", "frame", "image", "photo", "photograph", "picture", "view")
VIEW_TERMS = ("close", "profile", "side", "cropped", "image", "photo", "picture")
PREPOSITIONS = ("against", "amid", "among", "before", "in", "on", "over", "with")


@functools.lru_cache(maxsize=65_536)
def normal(word: str) -> str:
    """A noun phrase in lookup form: lower case, single blanks, its end singular."""
    word = word.strip().lower()
    if not word.isalnum():  # else there is nothing to replace
        word = re.sub(r"\s+", " ", re.sub(r"[_\s]+", " ", word).replace("-", " "))
    if word in IRREGULAR:
        return IRREGULAR[word]
    if word in PLURAL_ONLY:
        return word
    if word.endswith("ies") and len(word) > 4:
        return word[:-3] + "y"
    return word[:-1] if word.endswith("s") and len(word) > 3 and not word.endswith("ss") else word


def plural(noun: str) -> str:
    lead, _, head = noun.rpartition(" ")
    if head in PLURALS:
        made = PLURALS[head]
    elif head.endswith(("s", "x", "z", "ch", "sh")):
        made = head + "es"
    elif len(head) > 1 and head[-1] == "y" and head[-2] not in "aeiou":
        made = head[:-1] + "ies"
    else:
        made = head + "s"
    return f"{lead} {made}" if lead else made


def looks_plural(surface: str) -> bool:
    surface = surface.lower()
    head = surface.rsplit(" ", 1)[-1]
    return surface in PLURAL_SURFACES or head in ("children", "feet", "men", "people", "teeth", "women") or (head.endswith("s") and not head.endswith(("ss", "us", "is")))


class Lexicon:
    """Senses of nouns: `lemmas` are (lemma, synset), `edges` (child, parent) synsets."""

    def __init__(self, lemmas: Iterable[tuple[str, str]] = (), edges: Iterable[tuple[str, str]] = ()) -> None:
        self.senses, self.parents, self.names = defaultdict(set), defaultdict(set), defaultdict(set)
        for lemma, synset in lemmas:
            self.senses[normal(lemma)].add(synset)
            self.names[synset].add(normal(lemma))
        for child, parent in edges:
            self.parents[child].add(parent)

    def relation(self, expected: str, said: str) -> str | None:
        """How a word said fits an expected one: at most one hop, never over a generic endpoint."""
        if expected == said:
            return "exact_lemma"
        a, b = self.senses.get(expected, set()), self.senses.get(said, set())
        if a & b:
            return "same_synset"
        if expected in GENERIC or said in GENERIC:
            return None
        if any(self.parents.get(x, set()) & b for x in a):
            return "expected_is_direct_hyponym"
        return "expected_is_direct_hypernym" if any(self.parents.get(y, set()) & a for y in b) else None

    def fits(self, expected: Iterable[str], said: Iterable[str]) -> bool:
        said = list(said)
        return any(self.relation(e, s) for e in expected for s in said)

    def is_a(self, word: str, category: str, depth: int = 4) -> bool:
        word, category = normal(word), normal(category)
        if word == category:
            return True
        aim, seen = self.senses.get(category, set()), set(self.senses.get(word, set()))
        level = set(seen)
        for _ in range(depth):
            level = {p for x in level for p in self.parents.get(x, ())} - seen
            if level & aim:
                return True
            seen |= level
        return False

    def any_is(self, words: Iterable[str], category: str, depth: int = 4) -> bool:
        return any(self.is_a(w, category, depth) for w in words)

    def body_parts(self, words: set[str]) -> bool:
        return bool(words & {normal(w) for w in BODY_PARTS}) or self.any_is(words, "body part", 5)

    def clothing(self, words: set[str]) -> bool:
        return bool(words & {normal(w) for w in CLOTHING}) or self.any_is(words, "clothing", 5) or self.any_is(words, "garment", 5)

    def alternatives(self, word: str) -> set[str]:
        """Lemmas of the word's synsets and of those one hop away."""
        own = self.senses.get(normal(word), set())
        near = own | {p for x in own for p in self.parents.get(x, ())} | {c for c, ps in self.parents.items() if ps & own}
        return {n for s in near for n in self.names[s]} - {normal(word)}


class PlainParser:
    """Stands in for a parser.  Nouns: alphabetic words that aren't stop words, or only those of `known`, if given.

    A real one gives the same three answers: nouns(text), mentions(caption), relations(caption).
    """

    _PHRASE = re.compile(r"[A-Za-z]+(?:-[A-Za-z]+)*")
    _PRONOUNS = frozenset(REFERENCES) - {"one", "other", "that", "this"}
    _DETERMINERS = frozenset(("a", "an", "the", "this", "that", "his", "her", "its", "their", "one", "two", "three", "both", "several"))

    def __init__(self, known: Iterable[str] | None = None, verbs: Iterable[str] = ("holds", "holding", "carries", "carrying", "touches", "wears")) -> None:
        self.known = None if known is None else {normal(k) for k in known}
        self.verbs = set(verbs)

    def nouns(self, text: str) -> set[str]:
        words = {w.lower() for w in set(re.findall(r"[A-Za-z]+", text or ""))}
        return {w for w in words if (self.known is None or normal(w) in self.known) and w not in STOP}

    def mentions(self, caption: str, first: bool = False) -> list[dict]:
        """Noun phrases (determiner, up to three words, noun) and pronouns in order, none inside another; `first`: up to the first noun phrase."""
        words = [(m.start(), m.end(), m[0].lower()) for m in self._PHRASE.finditer(caption)]
        out, at = [], 0
        while at < len(words) and not (first and out and out[-1]["kind"] == "noun_phrase"):
            start, end, word = words[at]
            if word in self._PRONOUNS:
                follows = self._noun_after(caption, words, at + 1)
                out.append({"start": start, "end": end, "text": caption[start:end], "kind": "person_reference", "head": word, "noun_terms": []})
                if follows is not None and word in self._DETERMINERS:
                    out.append(self._phrase(caption, words, at, follows))
                    at = follows + 1
                    continue
            elif word in self._DETERMINERS and (head := self._noun_after(caption, words, at + 1)) is not None:
                out.append(self._phrase(caption, words, at, head))
                at = head + 1
                continue
            elif self._is_noun(word):
                out.append(self._phrase(caption, words, at, at))
            at += 1
        return out

    def _is_noun(self, word: str) -> bool:
        return self.known is not None and normal(word) in self.known and word not in STOP and word not in REFERENCES and word not in self.verbs

    def _noun_after(self, caption, words, at: int) -> int | None:
        for k in range(at, min(at + 4, len(words))):
            if re.search(r"[.,;!?]", caption[words[k - 1][1] : words[k][0]]) or words[k][2] in self.verbs or words[k][2] in STOP:
                return None
            if self._is_noun(words[k][2]):
                while k + 1 < len(words) and self._is_noun(words[k + 1][2]) and caption[words[k][1] : words[k + 1][0]] == " ":
                    k += 1
                return k
        return None

    def _phrase(self, caption, words, first: int, last: int) -> dict:
        s, e = words[first][0], words[last][1]
        return {"start": s, "end": e, "text": caption[s:e], "kind": "noun_phrase", "head": words[last][2], "noun_terms": sorted({normal(w) for _, _, w in words[first : last + 1] if self._is_noun(w)})}

    def backgrounds(self, text: str) -> list[tuple[int, int]]:
        """Ranges of background and view noun phrases with the preposition before them."""
        words = [(m.start(), m.end(), m[0].lower()) for m in self._PHRASE.finditer(text)]
        out = []
        for k, (_, end, word) in enumerate(words):
            lead = [w for _, _, w in words[max(0, k - 3) : k]]
            if word in BACKGROUND or (word in VIEWS and any(any(t in w for t in VIEW_TERMS) for w in lead)):
                first = next((i for i in range(k - 1, max(-1, k - 5), -1) if words[i][2] in PREPOSITIONS), None)
                start = words[first][0] if first is not None else next((words[i][0] for i in range(k - 1, max(-1, k - 4), -1) if words[i][2] in ("a", "an", "the")), words[k][0])
                out.append((start, end))
        return out

    def candidate(self, text: str) -> str:
        """The noun that a description is about: the head of its first noun phrase, else its last word that isn't a stop word."""
        found = [m for m in self.mentions(text, True) if m["kind"] == "noun_phrase"]
        if found:
            head = found[0]["noun_terms"]
            return " ".join(w for w in (normal(x.lower()) for x in re.findall(r"[A-Za-z]+", found[0]["text"])) if w in head)
        words = [w.lower() for w in re.findall(r"[A-Za-z]+", text) if w.lower() not in STOP]
        return words[-1] if words else ""

    def relations(self, caption: str) -> list[dict]:
        return [{"verb": word, "verb_span": (m.start(), m.end()), "subject_span": None, "object_span": None} for m in self._PHRASE.finditer(caption) if (word := m[0].lower()) in self.verbs]


def terms(parser, text: str) -> set[str]:
    """Normal forms of a text's nouns, without reference words; plural-only nouns as they are."""
    found = {normal(w) for w in parser.nouns(text) if len(w) > 1 and w.lower() not in REFERENCES}
    low = (text or "").lower()
    return found | {w for w in PLURAL_SURFACES if w in low and re.search(rf"(?<![a-z]){w}(?![a-z])", low)}
