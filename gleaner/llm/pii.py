"""Personal information inside free text: found by anchors, replaced by typed placeholders.

One automaton over the folded text finds the anchors: at-signs and their spellings, schemes, identity cues, digits, name
words, titles, kinds of street. Around each anchor a small deterministic parser looks for the bounds of the value and
validates it. Names are runs of capital words besides: which words are ordinary, which belong to chains and products, and
which further words are names is learned from the whole corpus. Folding keeps offsets, so replacements are made in the
text as written.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.canon import DIRECTIONS, NUMBER_WORDS, STREET_KINDS
from gleaner.llm.lookalike import INVISIBLE, LOOK_ALIKES
from gleaner.runtime import materialise

TYPES = ("email", "phone", "identity_number", "street_address", "name")
PLACEHOLDERS = {t: f"[{t.upper()}]" for t in TYPES}

#: Titles; words for what a person is to the writer or does; closed classes of words that are no part of a
#: name; words that places are named with.
TITLES = ("dr", "mr", "mrs", "ms", "mx", "prof", "miss", "sr", "sra", "mme")
ROLES = set(
    "manager supervisor owner boss cashier clerk butcher baker chef cook barista waiter waitress server driver courier employee coworker colleague assistant director president"
    " neighbor neighbour friend roommate landlord landlady tenant cousin uncle aunt brother sister mother father mom dad husband wife son daughter partner nephew niece"
    " plumber electrician contractor mechanic carpenter nurse doctor dentist teacher professor coach lawyer attorney agent officer judge pharmacist vet guy lady man woman person"
    " customer shopper author reviewer name named called contact attn regards signed sincerely".split()
)
CLOSED_CLASS = set(
    "a an the and or but nor for from with without to of in on at by off out up down over under near around through via per into onto about after before since until during"
    " is are was were be been being am do does did has have had can could will would shall should may might must not no yes if so as than then there here when where who whom"
    " what why how which that this these those it its i you he she we they me him her us them my your his our their mine yours every each all any both few more most other some"
    " such only own same too very just now also again ever never always often sometimes please thanks thank ask tell poor yesterday today tomorrow hello hi hey dear sorry ok okay"
    " monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december"
    " el la los las un una de del y o en con por para que es le les des du et ou dans avec pour sur est une os das dos em com não um".split()
)
PLACE_WORDS = set(
    "plaza village landing point junction square center centre mall park county heights hill hills valley beach bay harbor harbour island river lake bridge station airport"
    " university college school church hospital building tower market shop store kitchen restaurant cafe pantry corner".split()
)
PLACE_LEADS = set("north south east west upper lower new old fort mount lake port saint san santa los las el".split())
AT_PLACE = set("in at near on around through via off".split())
PARTICLES = ("de", "da", "di", "del", "della", "van", "von", "der", "den", "la", "le", "bin", "al", "el", "ter", "af", "y")
SCHEMES = ("mailto:", "tel:", "sms:", "callto:")
IDENTITY_CUES = {
    "ssn": "ssn", "social security": "ssn", "social-security": "ssn", "social insurance": "ssn", "social-insurance": "ssn", "social:": "ssn", "social is": "ssn",
    "sin:": "ssn", "sin ": "ssn", "licen": "licence", "dl:": "licence", "dl ": "licence", "passport": "passport",
}
#: Characters: the longest local part and domain of an address (as the mail standard has it), a sentence that a cue
#: reaches over, and what stands before a kind of street.
LOCAL_PART, DOMAIN, SENTENCE, LEAD = 64, 253, 1_000, 80
AT_SIGNS = ("@", "(at)", "[at]", "{at}")
DOTS = (" dot ", "[dot]", "(dot)", "{dot}")


@lru_cache(maxsize=1)
def _fold_table() -> dict[int, str | None]:
    """One character to one, or to none where it shows nothing: look-alikes, width forms and accents folded."""
    table: dict[int, str | None] = {ord(ch): None for ch in INVISIBLE}
    for latin, others in LOOK_ALIKES.items():
        if len(latin) == 1:
            table.update({ord(ch): latin for ch in others})
    for cp in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), *range(0xFF01, 0xFF5F), 0x3000, 0x212A]:
        ch = chr(cp)
        plain = unicodedata.normalize("NFKD", ch)
        if plain and plain[0] != ch and plain[0].isascii() and all(unicodedata.combining(c) for c in plain[1:]):
            table.setdefault(cp, plain[0])
    table.update({0x300 + i: None for i in range(0x70)})
    table.update({ord(a): b for a, b in zip("ØøŁłĐđ’‘ʼ", "OoLlDd'''", strict=True)})
    table.update({0xFB00: "f", 0xFB01: "f", 0xFB02: "f"})
    return table


_BEYOND_ASCII = re.compile(r"[^\x00-\x7f]+")


def fold(text: str) -> tuple[str, list[int] | None]:
    """The folded text, and the offset of each of its characters in the text (none: the same offsets)."""
    if text.isascii():
        return text, None
    table = _fold_table()
    folded = _BEYOND_ASCII.sub(lambda m: m.group().translate(table), text)
    if len(folded) == len(text):
        return folded, None
    return folded, [i for i, ch in enumerate(text) if table.get(ord(ch), ch) is not None]


_WORD = r"[A-Za-z]+(?:['\-][A-Za-z]+)*"
_CAPITAL = r"[A-Z][A-Za-z]*(?:['\-][A-Za-z]+)*"
_INITIAL = r"(?:[A-Z]|Dr|DR|Mrs?|MRS?|Ms|MS|Mx|MX|Prof|PROF|Sra?|Mme)\."
_CAPITALS = re.compile(rf"(?<![\w@'\-/])(?<!\w\.)(?:{_INITIAL}|{_CAPITAL})(?:  ?(?:{_INITIAL}|{_CAPITAL}|(?:(?:{'|'.join(PARTICLES)}) )+{_CAPITAL}))+(?![\w@/])")
_CAPITAL_WORDS = re.compile(rf"(?<![\w'\-]){_CAPITAL}(?:  ?{_CAPITAL})*(?![\w'\-])")
_LOWER = re.compile(r"(?<![\w'\-.@+/])[a-z]+(?:['\-][a-z]+)*(?![\w'\-@+/])(?!\.\w)")
_REVERSED = re.compile(rf"({_WORD}), ({_WORD})(?:  ?([A-Z])\b\.?)?")
_NAME_WORD = re.compile(_WORD)
_RUN_OF_DIGITS = frozenset("0123456789 ().-/+\t")
_ABROAD = re.compile(r"(?<![\w$#.])\+[2-9][\d .()\-/]*\d(?!\w)")
_BREAK = re.compile(r"(?<!\bno)(?<!\bNo)(?<!\bnum)[.!?]\s+(?=[A-Z])|\n")
_BEFORE = re.compile(r"([A-Za-z]+)(?:[.:,]|\.:)?\s{0,2}\Z")
_OPENS = re.compile(r"(?:\A|[\n.!?。])[\s\"'(]*\Z")
_DASH = re.compile(r"(?:^|[\n.!?])\s*(?:—|–|-|~)\s*\Z")
_PHONE = re.compile(r"(?<![\w$#.])(?:\+?1[ .\-/]?)?(?:\(\d{3}\) ?|\d{3}[ .\-/]?)\d{3}[ .\-/]?\d{4}(?![\w])(?!-\d)(?:,? ?(?:ext\.?|x|extension) ?\d{1,6})?", re.I)
_SSN_SHAPE = re.compile(r"(?<![\w$#.\-])\d{3}([ \-.])\d{2}\1\d{4}(?![\w\-])")
_SSN_CUED = re.compile(r"(?<![\w$])\d{3}[ \-./]?(?:\d{2}[ \-./]?\d{4}|\d{3}[ \-./]?\d{3})(?![\w\-])")
_LICENCE = re.compile(r"(?<!\w)[A-Z]{1,2}[ \-]?\d{6,9}(?!\w)", re.I)
_PASSPORT = re.compile(r"(?<!\w)(?:[A-Z]{1,2}[ \-]?\d{6,8}[A-Z]?|(?=(?:[A-Z]*\d){4})[A-Z][A-Z\d]{8})(?!\w)", re.I)
_LOCAL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+\-']*\Z")
_DOT = r"(?:\.| ?[\[({]dot[\])}] ?| dot )"
_DOMAIN = re.compile(rf"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:{_DOT}[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?)*{_DOT}[A-Za-z]{{2,24}}(?![A-Za-z0-9])", re.I)
_SPELT_AT = re.compile(rf"([A-Za-z0-9][A-Za-z0-9._%+\-']*) at ({_DOMAIN.pattern})", re.I)
_KIND_WORDS = {w for k, ws in STREET_KINDS.items() for w in [k, *ws.split()]} - {"pl"}
DIGIT_WORDS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
_SPELT_RUN = re.compile(rf"(?<![\w$])(?:(?:\+?\d{{1,4}}|{'|'.join(DIGIT_WORDS)})(?:[ \-.,]{{1,2}}|\b)){{4,14}}", re.I)
_NUMBER_WORD = "(?:" + "|".join(sorted(NUMBER_WORDS, key=len, reverse=True)) + ")"
_HOUSE = re.compile(
    rf"(?:(?<!\w)(?:unit|apt\.?|suite|ste\.?) ?#? ?\w{{1,5}}, ?)?(?<![\w$/.\-])(\d{{1,5}}(?:-\d{{1,5}})?(?: ?[A-Za-z])?(?: 1/2)?|{_NUMBER_WORD}(?:[ \-]{_NUMBER_WORD})*)"
    rf",? +((?:(?:{'|'.join(DIRECTIONS)}|[NSEW]\.?) +)?(?:{_WORD}(?: +{_WORD})?|\d{{1,3}}(?:st|nd|rd|th))) +\Z",
    re.I,
)
#: Streets as other languages write them: the kind first, or as the end of the word, with a capital name.
_STREET_ABROAD = re.compile(
    r"(?<![\w$/.\-])\d{1,4}(?:bis|ter)?,? (?:[Rr]ue|[Bb]oulevard|[Aa]venue|[Pp]lace|[Qq]uai|[Cc]hemin)(?: (?:de la|de l'|des|du|de|d'))? ?[A-Z][\w'\-]+(?: [A-Z][\w'\-]+)?"
    r"|\b(?:[Cc]alle|[Aa]venida|[Rr]ua|Plaza|Via|Piazza|[Pp]aseo|[Tt]ravessa)(?: (?:de la|de los|de|del|da|do|dos|das))? [A-Z][\w'\-]+(?: [A-Z][\w'\-]+)?,? (?:n[o.]* ?)?\d{1,4}(?![\w$%])"
    r"|\b[A-Z][a-z]+(?:strasse|stra(?:ss|s)e|weg|platz|gasse|allee) \d{1,4} ?[a-z]?(?![\w$%])"
)
_KINDS_ABROAD = ("rue", "boulevard", "avenue", "place", "quai", "chemin", "calle", "avenida", "rua", "plaza", "via", "piazza", "paseo", "travessa", "strasse", "strase", "weg", "platz", "gasse", "allee")
_ABROAD_ONLY = ("abroad",)
_UNIT_AFTER = re.compile(r",? ?(?:(?:apt|unit|suite|ste|floor|fl)\b\.? ?#? ?\w{1,5}|#\d+)", re.I)
_PLACES = PLACE_WORDS | _KIND_WORDS
_NOT_STREETS = CLOSED_CLASS | set("minutes hours days visits times stars things items pieces good long short easy right wrong hard half single o'clock".split())


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str


@dataclass(frozen=True)
class Facts:
    """What a corpus says of words, in lower case: ordinary ones, words and pairs of words that stand for chains, products
    or places, and given and family names beside those of the list."""

    ordinary: frozenset[str] = frozenset()
    entities: frozenset[str] = frozenset()
    given: frozenset[str] = frozenset()
    family: frozenset[str] = frozenset()


Token = tuple[int, int, str, str]  # start, end, as written, lower case


class Finder:
    """Finds spans of personal information. given, family: name words known; they need not be complete. facts: of the
    corpus; without any, capital words are judged by structure alone."""

    def __init__(self, given: Iterable[str], family: Iterable[str], facts: Facts = Facts()) -> None:
        self.listed_given, self.listed_family = _flat(given), _flat(family)
        self.given, self.family = self.listed_given | facts.given, self.listed_family | facts.family
        self.ordinary, self.entities = facts.ordinary, facts.entities
        known = self.given | self.family
        self.never = CLOSED_CLASS | ROLES | set(TITLES) | (facts.ordinary - known)
        self.apart = self.never | (facts.entities - known)
        self.automaton = ahocorasick.Automaton()
        anchors: dict[str, set[str]] = {}
        for words, kind in (
            (AT_SIGNS, "at"), (DOTS, "dot"), (IDENTITY_CUES, "identity"), (self.given | self.family, "name"), (_KIND_WORDS, "street"), (DIGIT_WORDS, "digit"), (SCHEMES, "scheme"),
            ([f"{i:03}" for i in range(1000)] + [f"+{i}" for i in range(10)], "number"), (_KINDS_ABROAD, "abroad"),
        ):
            for w in words:
                anchors.setdefault(w, set()).add(kind)
        for w, kinds in anchors.items():
            self.automaton.add_word(w, (len(w), w, tuple(sorted(kinds))))
        self.automaton.make_automaton()

    def find(self, text: str | None) -> list[Span]:
        """Spans in text, in order, none within another. Null and empty text have none; the whole text is searched."""
        if not text:
            return []
        folded, offsets = fold(text)
        spans = self._find(folded)
        if offsets is not None and spans:
            offsets = [*offsets, len(text)]
            spans = [Span(offsets[s.start], offsets[s.end - 1] + 1, s.kind) for s in spans]
        return spans

    def _find(self, t: str) -> list[Span]:
        low = t.lower()
        if len(low) != len(t):
            low = "".join(ch.lower() if len(ch.lower()) == 1 else ch for ch in t)
        hits: dict[str, list[tuple[int, int, str]]] = {}
        for end, (n, word, kinds) in self.automaton.iter(low):
            start = end - n + 1
            if word[0].isalpha() and start and low[start - 1].isalnum() and kinds != _ABROAD_ONLY or word[-1].isalpha() and word != "licen" and end + 1 < len(low) and low[end + 1].isalnum():
                continue
            for kind in kinds:
                hits.setdefault(kind, []).append((start, end + 1, word))
        taken = _merge([*self._emails(t, hits), *self._numbers(t, low, hits), *self._streets(t, low, hits)])
        names = [s for s in self._names(t, low, hits) if not any(s.start < x.end and x.start < s.end for x in taken)]
        return _merge([*taken, *names])

    def _emails(self, t: str, hits: dict) -> Iterator[Span]:
        for start, end, _ in hits.get("at", ()):
            left = t[max(0, start - LOCAL_PART) : start]
            gap = len(left) - len(left.rstrip(" "))
            local = _LOCAL.search(left.rstrip(" ")) if gap <= 2 else None
            right = end + (len(t[end : end + 3]) - len(t[end : end + 3].lstrip(" ")))
            domain = _DOMAIN.match(t, right, right + DOMAIN)
            if local and domain and right - end <= 2:
                yield Span(max(0, start - LOCAL_PART) + local.start(), domain.end(), "email")
        seen = -1
        for start, _, _ in hits.get("dot", ()):
            if start < seen:
                continue
            for m in _SPELT_AT.finditer(t, max(0, seen, start - LOCAL_PART - DOMAIN), min(len(t), start + DOMAIN)):
                if m.start() <= start < m.end():
                    yield Span(m.start(), m.end(), "email")
                    seen = m.end()

    def _numbers(self, t: str, low: str, hits: dict) -> Iterator[Span]:
        cued: list[tuple[int, int]] = []
        cues = hits.get("identity", ())
        for i, (start, end, word) in enumerate(cues):
            kind = IDENTITY_CUES[word]
            shape = {"ssn": _SSN_CUED, "licence": _LICENCE, "passport": _PASSPORT}[kind]
            # up to the next cue or the end of the sentence
            stop = next((s for s, _, w in cues[i + 1 : i + 9] if s >= end and IDENTITY_CUES[w] != kind), len(t))
            m = shape.search(t, end, min(stop, end + SENTENCE))
            if m and not _BREAK.search(t, end, m.start() + 1) and _possible(kind, m.group()):
                cued.append((m.start(), m.end()))
                yield Span(m.start(), m.end(), "identity_number")
        told = {end for _, end, _ in hits.get("scheme", ())}
        done = 0
        for start, _, _ in hits.get("number", ()):
            if start < done:
                continue
            a, b = start, start
            while a > done and t[a - 1] in _RUN_OF_DIGITS:
                a -= 1
            while b < len(t) and t[b] in _RUN_OF_DIGITS:
                b += 1
            done = b
            if sum(ch.isdigit() for ch in t[a:b]) < 7:
                continue
            for m in _SSN_SHAPE.finditer(t, a, b):
                if _possible("ssn", m.group()):
                    cued.append((m.start(), m.end()))
                    yield Span(m.start(), m.end(), "identity_number")
            for m in _ABROAD.finditer(t, a, b):
                if 8 <= sum(ch.isdigit() for ch in m.group()) <= 15:
                    yield Span(m.start(), m.end(), "phone")
            for m in _PHONE.finditer(t, a, min(len(t), b + 14)):
                digits = re.sub(r"\D", "", re.split(r"(?i)e?x", m.group())[0])[-10:]
                if digits[0] in "01" or digits[3] in "01" or any(x < m.end() and m.start() < y for x, y in cued):
                    continue
                bare = m.group().isdigit() and m.start() not in told
                if bare and re.search(r"(?i)(?:order|item|upc|sku|receipt|code|ref(?:erence)?|number) ?#? ?$", t[max(0, m.start() - 12) : m.start()]):
                    continue
                yield Span(m.start(), m.end(), "phone")
        done = -1
        spelt = sorted(hits.get("digit", ()))
        for i, (start, _, _) in enumerate(spelt):
            # several digits in words close by
            if start < done or i + 2 >= len(spelt) or spelt[i + 2][0] - start > 24:
                continue
            for m in _SPELT_RUN.finditer(t, max(0, start - 16), min(len(t), start + 110)):
                text = m.group().rstrip(" -.,")
                digits = "".join(DIGIT_WORDS.get(w, w) for w in re.findall(r"[a-z]+|\d+", text.lower()))
                if m.start() <= start < m.end() and (len(digits) == 10 or len(digits) == 11 and digits[0] == "1") and digits[-10] not in "01":
                    yield Span(m.start(), m.start() + len(text), "phone")
                    done = m.end()

    def _streets(self, t: str, low: str, hits: dict) -> Iterator[Span]:
        for start, end, _ in hits.get("street", ()):
            m = _HOUSE.search(t[max(0, start - LEAD) : start])
            if not m:
                continue
            base = m.group(2).split()
            if any(w.lower() in _NOT_STREETS for w in base) or len(base[-1]) < 3:
                continue
            if not all(w[0].isupper() or w[0].isdigit() for w in base) and len(base) > 1:
                continue
            first = max(0, start - LEAD) + m.start()
            after = _UNIT_AFTER.match(t, end + (t[end : end + 1] == "."))
            yield Span(first, after.end() if after else end, "street_address")
        if "abroad" in hits:
            for m in _STREET_ABROAD.finditer(t):
                yield Span(m.start(), m.end(), "street_address")

    def _names(self, t: str, low: str, hits: dict) -> Iterator[Span]:
        """Full names: runs of capital words, and known name words in any case with what stands beside them."""
        for m in _CAPITALS.finditer(t):
            yield from self._in_capitals(t, m.start(), m.end())
        done = -1
        for start, end, _ in hits.get("name", ()):
            if start >= done and not (start and t[start - 1] in "_/@+." or end < len(t) and t[end] in "_@+"):
                found = self._reversed(t, start) or self._plain(t, start, end)
                if found:
                    done = found.end
                    yield found

    def _stands_for_another(self, a: str, b: str) -> bool:
        return f"{a} {b}" in self.entities and not (a in self.listed_given and b in self.listed_family)

    def _in_capitals(self, t: str, start: int, end: int) -> Iterator[Span]:
        tokens: list[Token] = [(m.start(), m.end(), m.group(), m.group().lower()) for m in _NAME_WORD.finditer(t, start, end)]
        inside = [0 < i < len(tokens) - 1 and w[2].islower() for i, w in enumerate(tokens)]  # particles
        apart = [not p and w[3] in self.apart for w, p in zip(tokens, inside, strict=True)]
        if len(apart) - sum(apart) < 2:
            return
        for i in range(len(tokens) - 1):
            if self._stands_for_another(tokens[i][3], tokens[i + 1][3]):
                apart[i] = apart[i + 1] = True
        i = 0
        while i < len(tokens):
            if apart[i] or len(tokens[i][2]) == 1:
                i += 1
                continue
            j = i
            while j < len(tokens) and not apart[j]:
                j += 1
            following = tokens[j][3] if j < len(tokens) else ""
            found = self._person(t, tokens[i:j], tokens[i - 1][3] if i else None, following)
            if found:
                yield found
            i = j

    def _person(self, t: str, words: list[Token], before: str | None, following: str) -> Span | None:
        """The full name that capital words are, if they are one. before: the word of the run before them, if any."""
        while words and (len(words[-1][2]) == 1 or words[-1][2].islower()):
            words = words[:-1]
        while words and words[0][2].islower():
            words = words[1:]
        if not 2 <= len(words) <= 5:
            return None
        a, b = words[0], words[-1]
        given, family = a[3] in self.given, b[3] in self.family
        span = Span(a[0], b[1], "name")
        if given and family:
            return span
        if any(w[3] in _PLACES and not w[2].islower() for w in words) or following in _PLACES and not (given or family) or a[3] in PLACE_LEADS or len(a[2]) < 2:
            return None
        if family and a[3] not in self.family:
            return span
        if b[3] in self.given and not family and a[3] in self.given:
            return None
        if given and len(b[2]) > 2 and (a[3] not in self.ordinary or self._cued(t, a[0])):
            return span
        if len(a[2]) < 3 or len(b[2]) < 3:
            return None
        cue = before in TITLES or before in ROLES if before is not None else False
        if any(w[2].islower() for w in words) and not cue and _OPENS.search(t, max(0, a[0] - 8), a[0]):
            return None  # "Close to Town": the capital may be that of a sentence
        return span if cue or not self._at_place(t, a[0]) else None

    def _at_place(self, t: str, at: int) -> bool:
        m = _BEFORE.search(t, max(0, at - 24), at)
        return bool(m and m.group(1).lower() in AT_PLACE)

    def _cued(self, t: str, at: int) -> bool:
        """A person is what can stand here: after a title, a role or the dash of a signature."""
        m = _BEFORE.search(t, max(0, at - 24), at)
        return bool(m and (m.group(1).lower() in TITLES or m.group(1).lower() in ROLES) or _DASH.search(t, max(0, at - 8), at))

    def _next_word(self, t: str, at: int) -> Token | None:
        """The word one or two spaces on."""
        m = re.compile(rf"\.?  ?({_WORD})").match(t, at)
        return (m.start(1), m.end(1), m.group(1), m.group(1).lower()) if m else None

    def _plain(self, t: str, start: int, end: int) -> Span | None:
        """A name in text without capitals, from a known word on: both words known, or one and a cue for the other."""
        word = t[start:end].lower()
        if word in self.given:
            b = self._next_word(t, end)
            if b and (len(b[2]) == 1 or b[3] in self.given and b[3] not in self.family):
                b = self._next_word(t, b[1])
            if b and b[3] in self.family and not self._stands_for_another(word, b[3]):
                return Span(start, b[1], "name")
            if b and b[2].islower() and t[start].islower() and len(b[2]) > 3 and word not in self.ordinary and b[3] not in self.never and self._cued(t, start):
                return Span(start, b[1], "name")
        elif word in self.family and t[start].islower():
            m = re.compile(rf"(?<![\w./@'\-])({_WORD})  ?(?:[a-z]\.?  ?)?\Z").search(t, max(0, start - 40), start)
            if m and m.group(1).islower() and len(m.group(1)) > 2 and m.group(1) not in self.never and self._cued(t, m.start()):
                return Span(m.start(), end, "name")
        return None

    def _reversed(self, t: str, at: int) -> Span | None:
        """Family, Given"""
        m = _REVERSED.match(t, at)
        if not m or m.group(1).lower() in self.given:
            return None
        a, b = m.group(1).lower(), m.group(2).lower()
        if b in self.given or m.group(2)[0].isupper() and m.group(1)[0].isupper() and b not in self.never and b not in self.entities and self._cued(t, at):
            return Span(m.start(), m.end(), "name")
        return None


def _flat(words: Iterable[str]) -> set[str]:
    return {fold(w)[0].lower() for w in words if w and w.strip()}


def _possible(kind: str, value: str) -> bool:
    """Numbers that were never given out: an area of 000 or 666, a group of 00, a serial of 0000. The check digit of
    insurance numbers is not asked for: behind a cue a mistyped number is personal, too."""
    digits = re.sub(r"\D", "", value)
    return kind != "ssn" or not (digits[:3] in ("000", "666") or re.match(r"\d{3}\D?\d{2}\D?\d{4}\Z", value) and (digits[3:5] == "00" or digits[5:] == "0000"))


def _merge(spans: Sequence[Span]) -> list[Span]:
    """In order; of overlapping spans the earlier and longer one stays."""
    out: list[Span] = []
    for s in sorted(spans, key=lambda s: (s.start, -s.end, TYPES.index(s.kind))):
        if not out or s.start >= out[-1].end:
            out.append(s)
    return out


def redact(text: str | None, spans: Sequence[Span]) -> str | None:
    """text with each span replaced by its type's placeholder; all else as written."""
    if text is None:
        return None
    parts, at = [], 0
    for s in spans:
        parts += [text[at : s.start], PLACEHOLDERS[s.kind]]
        at = s.end
    return "".join([*parts, text[at:]])


def listed(names: DataFrame, most: int = 100_000) -> tuple[list[str], list[str]]:
    rows = names.select("name", "name_kind").where("name is not null").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} names; the automaton would not fit")
    return [r[0] for r in rows if r[1] == "given"], [r[0] for r in rows if r[1] == "family"]


@dataclass(frozen=True)
class FactSettings:
    """words: most ordinary words and most learned names that are kept, the most frequent ones; it bounds what is broadcast.
    lower: least share of lower case, and least count, of an ordinary word. entity, pair: the share of all texts from which
    a capital word or a pair of them is no private person, and the least count. learned, share: beside how many
    different listed names a word must stand, and that share of all its capital uses."""

    words: int = 100_000
    lower: float = 0.3
    lower_count: int = 3
    entity: float = 0.005
    pair: float = 0.001
    least: int = 20
    learned: int = 2
    share: float = 0.2


def corpus_facts(df: DataFrame, names: tuple[list[str], list[str]], fields: Sequence[str], settings: FactSettings = FactSettings()) -> Facts:
    """Facts counted over all texts of the fields; of the counts at most 2 * words and the frequent pairs come to the driver."""
    shared = df.sparkSession.sparkContext.broadcast(names)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given, family = (_flat(x) for x in shared.value)
        for batch in batches:
            texts = 0
            lower: Counter[str] = Counter()
            runs: Counter[str] = Counter()
            for field in fields:
                for text in batch[field]:
                    if text:
                        texts += 1
                        t = fold(text)[0]
                        lower.update(_LOWER.findall(t))
                        runs.update(_CAPITAL_WORDS.findall(t))
            found: Counter[tuple[str, str]] = Counter({("texts", ""): texts})
            found.update({("lower", w): n for w, n in lower.items()})
            for run, n in runs.items():
                words = run.lower().replace("  ", " ").split(" ")
                for w in words:
                    found["capital", w] += n
                for a, b in zip(words, words[1:]):
                    found["pair", f"{a} {b}"] += n
                    if b in family:
                        found["given", f"{a} {b}"] += n
                    if a in given:
                        found["family", f"{b} {a}"] += n
            yield pd.DataFrame([(kind, w, n) for (kind, w), n in found.items()], columns=["kind", "word", "n"], dtype=object)

    counts = df.select(*fields).mapInPandas(count, "kind string, word string, n bigint").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "words")
    texts = counts.where("kind = 'texts'").agg(F.sum("n")).first()[0] or 0
    of = lambda c, kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(c))), F.lit(0))
    # how often a word stands beside listed names, and beside how many different ones
    beside = counts.where("kind in ('given', 'family')").groupBy("kind", F.substring_index("word", " ", 1).alias("word")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("partners"))
    each = counts.where("kind in ('lower', 'capital')").withColumn("partners", F.lit(0).cast("bigint")).unionByName(beside)
    words = each.groupBy("word").agg(
        *[of("n", k).alias(k) for k in ("lower", "capital", "given", "family")], *[of("partners", k).alias(f"{k}_partners") for k in ("given", "family")]
    )
    words = materialise(words, "words")
    ordinary = (F.col("lower") >= settings.lower_count) & (F.col("lower") >= settings.lower * (F.col("lower") + F.col("capital")))
    most = lambda d, by: frozenset(r["word"] for r in d.orderBy(F.desc(by), "word").limit(settings.words).select("word").collect())
    frequent = (F.col("capital") >= settings.least) & (F.col("capital") >= settings.entity * texts) & ~ordinary
    entities = most(words.where(frequent), "capital")
    pairs = counts.where("kind = 'pair'").where((F.col("n") >= settings.least) & (F.col("n") >= settings.pair * texts))
    learned = {}
    for kind in ("given", "family"):
        enough = (F.col(f"{kind}_partners") >= settings.learned) & (F.col(kind) >= settings.share * F.col("capital")) & (F.length("word") > 2) & ~ordinary & ~frequent
        learned[kind] = most(words.where(enough), kind)
    closed = CLOSED_CLASS | ROLES | set(TITLES) | PLACE_WORDS | _KIND_WORDS
    return Facts(most(words.where(ordinary), "lower"), entities | most(pairs, "n"), learned["given"] - closed, learned["family"] - closed)


def found_types(df: DataFrame, names: DataFrame, key: str, fields: Sequence[str], facts: Facts | None = None) -> DataFrame:
    """key, field, pii_type: once for each field and each type it holds at least once. Rows without key are left out.
    facts: of the corpus; without any they are counted over df."""
    known = listed(names)
    shared = df.sparkSession.sparkContext.broadcast((*known, corpus_facts(df, known, fields) if facts is None else facts))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(*shared.value)
        for batch in batches:
            keys, at, kinds = [], [], []
            for field in fields:
                for k, text in zip(batch[key], batch[field], strict=True):
                    if text:
                        for kind in {s.kind for s in finder.find(text)}:
                            keys.append(k)
                            at.append(field)
                            kinds.append(kind)
            yield pd.DataFrame({key: keys, "field": at, "pii_type": kinds}, dtype=object)

    return df.where(F.col(key).isNotNull()).select(key, *fields).mapInPandas(search, f"{key} bigint, field string, pii_type string")


def redacted(df: DataFrame, names: DataFrame, fields: Sequence[str], facts: Facts | None = None) -> DataFrame:
    """df with the fields' personal information replaced; other columns, nulls and empty texts as they were."""
    known = listed(names)
    shared = df.sparkSession.sparkContext.broadcast((*known, corpus_facts(df, known, fields) if facts is None else facts))
    cache: dict[str, Finder] = {}

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        if "f" not in cache:
            cache["f"] = Finder(*shared.value)
        find = cache["f"].find
        return texts.map(lambda x: redact(x, find(x)), na_action="ignore")

    return df.withColumns({f: clean(F.col(f)) for f in fields})
