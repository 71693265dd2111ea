import collections
import sys
import time
from pathlib import Path

import pytest

from gleaner.llm.pii import TYPES, Facts, Finder, corpus_facts, fold, found_types, redact, redacted

sys.path.insert(0, str(Path(__file__).parent))
from pii_sheet import cases  # noqa: E402

GIVEN, FAMILY = ["Basil", "Amadou", "Maëlle", "Ginger", "Noor"], ["Rademoor", "O'Tarrigan", "Tran-Oakley", "Ørskovic"]
ORDINARY = "basil ginger pesto snaps register fish counter mail call write street the lovely mini live cart".split()
F = Finder(GIVEN, FAMILY, Facts(frozenset(ORDINARY), frozenset(["trader joe's"])))


@pytest.mark.parametrize(
    "text,want",
    [
        ("mail me at a.b+c@mail.example now", "mail me at [EMAIL] now"),
        ("mail a.b @ mx.mail.test, or x [at] y [dot] test", "mail [EMAIL], or [EMAIL]"),
        ("write to rosa95 at posthut dot test please", "write to [EMAIL] please"),
        ("Got 2 lbs @ 4.99 and 3 @ 1.50 each.", "Got 2 lbs @ 4.99 and 3 @ 1.50 each."),
        ("call (617)5550144 or +1 857 555 0181 ext. 12", "call [PHONE] or [PHONE]"),
        ("call 508 five five five zero one eight five today", "call [PHONE] today"),
        ("Order #464845324, UPC 088902915375, Receipt 8351-1640-5869, since 2017-07-15", "Order #464845324, UPC 088902915375, Receipt 8351-1640-5869, since 2017-07-15"),
        ("SSN: 953405911 and 982-09-5280", "SSN: [IDENTITY_NUMBER] and [IDENTITY_NUMBER]"),
        ("my SIN 047 104-862, license S000198863, passport: X9662202Z", "my SIN [IDENTITY_NUMBER], license [IDENTITY_NUMBER], passport: [IDENTITY_NUMBER]"),
        ("Item 000-11-395 was $775", "Item 000-11-395 was $775"),
        ("I live at Unit 6, 67B Thuming Blvd #3 now", "I live at [STREET_ADDRESS] now"),
        ("left at Twenty-two Braimdale Way instead", "left at [STREET_ADDRESS] instead"),
        ("There are 2 on Drorkworth Street.", "There are 2 on Drorkworth Street."),
        ("Contact AMADOU K. RADEMOOR (a@b.example)", "Contact [NAME] ([EMAIL])"),
        ("Ask for Rademoor, Noor at the fish counter", "Ask for [NAME] at the fish counter"),
        ("— Uma Vasterlin, 857-555-0111", "— [NAME], [PHONE]"),
        ("The Basil Pesto and the Ginger Snaps at Trader Joe's", "The Basil Pesto and the Ginger Snaps at Trader Joe's"),
        ("Basil at the register was lovely. Contact Noor S.", "Basil at the register was lovely. Contact Noor S."),
        ("Cоntact Maëlle Ｏrskovic soon", "Cоntact [NAME] soon"),
        ("noor.rademoor@mail.example", "[EMAIL]"),
        ("", ""),
    ],
)
def test_placeholders(text, want):
    assert redact(text, F.find(text)) == want


def test_sheet():
    """Recall and precision on sentences of other matters; no name in them is on the list."""
    hit, all_, found = collections.Counter(), collections.Counter(), collections.Counter()
    for text, spans in cases():
        got = F.find(text)
        for a, b, kind in spans:
            all_[kind] += 1
            hit[kind] += any(s.kind == kind and s.start < b and a < s.end for s in got)
        for s in got:
            found[s.kind] += 1
    for kind in TYPES:
        assert hit[kind] >= 0.9 * all_[kind], kind
        assert hit[kind] >= 0.9 * found[kind], kind


def test_facts_of_a_corpus(spark):
    texts = ["the bread is fresh and the soup is warm", "Ask at Corner Shop for Corner Shop soup"] * 30
    texts += ["Noor Silvan came", "Amadou Silvan came", "Tilda Rademoor left", "Tilda Tran-Oakley left", "Basil Pesto is fresh", "Basil Pesto is warm"]
    facts = corpus_facts(spark.createDataFrame([(t, None) for t in texts], "a string, b string"), (GIVEN, FAMILY), ["a", "b"])
    assert {"the", "bread", "fresh", "soup"} <= facts.ordinary and "corner shop" in facts.entities
    assert facts.given == {"tilda"} and facts.family == {"silvan"}  # pesto stands beside one name only
    find = Finder(GIVEN, FAMILY, facts).find
    assert [s.kind for s in find("my friend tilda silvan waved")] == ["name"] and not find("The Corner Shop")


def test_offsets_survive_folding():
    text = "x​é SSN: 9​53-40-5911 ﬁn"
    folded, offsets = fold(text)
    assert len(folded) == len(offsets) and redact(text, F.find(text)) == "x​é SSN: [IDENTITY_NUMBER] ﬁn"


def test_long_texts_take_no_long():
    start = time.time()
    for t in ("a" * 500_000, "1" * 500_000, "a@" * 100_000, "Basil " * 100_000, "5 Main St " * 50_000, "one two " * 50_000, "(617) " * 80_000):
        F.find(t)
    assert time.time() - start < 60


def test_tables(spark):
    names = spark.createDataFrame([("Noor", "given"), ("Rademoor", "family"), (None, "given")], "name string, name_kind string")
    rows = [(1, "Contact Noor Rademoor, a@b.test or c@d.test", None, "x"), (2, None, "", "x"), (3, "none", "call 617-555-0100", "x"), (None, "a@b.test", None, "x")]
    df = spark.createDataFrame(rows, "id bigint, text string, parent_body string, field string")
    got = sorted(tuple(r) for r in found_types(df, names, "id", ["text", "parent_body"]).collect())
    assert got == [(1, "text", "email"), (1, "text", "name"), (3, "parent_body", "phone")]
    out = redacted(df, names, ["text", "parent_body"])
    assert out.columns == df.columns and out.where("id = 1").first()["text"] == "Contact [NAME], [EMAIL] or [EMAIL]" and out.where("id = 2").first()["text"] is None
    assert found_types(df.limit(0), names, "id", ["text"]).count() == 0 and redacted(df.limit(0), names.limit(0), ["text"]).count() == 0
