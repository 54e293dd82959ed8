import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terravane.llm import pii

from .conftest import ODD

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_force(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True, "card": 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@given(st.text("0123456789..--  ()+@ab_%é", max_size=60))
@settings(max_examples=600, deadline=None)
def test_base_spans(text):
    assert pii.base_spans(text) == brute_force(text)


@pytest.mark.parametrize(
    "text,kind,found",
    [
        ("write john dot doe at example dot com now", "email", "john dot doe at example dot com"),
        ("joe [at] mail (dot) org.", "email", "joe [at] mail (dot) org"),
        ("аdmin@exаmple.com", "email", "аdmin@exаmple.com"),
        ("call plus four four two zero seven nine four six zero nine five eight!", "phone", "plus four four two zero seven nine four six zero nine five eight"),
        ("ip one nine two dot one six eight dot one dot two ok", "ip", "one nine two dot one six eight dot one dot two"),
        ("４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
        ("zero\u200bwidth joe@ma\u200bil.org", "email", "joe@ma\u200bil.org"),
    ],
)
def test_disguises_map_back(text, kind, found):
    base, spans = pii.all_spans(text)
    assert (kind, found) in [(k, text[a:b]) for k, a, b in spans]
    assert set(base) <= set(spans)


@pytest.mark.parametrize(
    "text,kind,found",
    [
        ("at 192[.]168[.]1[.]1 now", "ip", "192[.]168[.]1[.]1"),
        ("at 192 dot 168 dot 1 dot 1 now", "ip", "192 dot 168 dot 1 dot 1"),
        ("192 (dot) 168.1 [dot] 1", "ip", "192 (dot) 168.1 [dot] 1"),
        ("one[.]two[.]three[.]four", "ip", "one[.]two[.]three[.]four"),
        ("192.168.1 dot one.", "ip", "192.168.1 dot one"),
        ("plus four four 7700900123", "phone", "plus four four 7700900123"),
        ("plus four four 7700900123 ext 4b", "phone", "plus four four 7700900123"),
        ("+1 415 555 267 one", "phone", "+1 415 555 267 one"),
        ("+44 one 7700900123", "phone", "+44 one 7700900123"),
        ("4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"),
        ("411111111111111 one", "card", "411111111111111 one"),
        ("joe at one[.]two[.]com", "email", "joe at one[.]two[.]com"),
        ("joe at mail5 dot 3com dot net", "email", "joe at mail5 dot 3com dot net"),
    ],
)
def test_disguises_in_part(text, kind, found):
    assert (kind, found) in [(k, text[a:b]) for k, a, b in pii.all_spans(text)[1]]


@pytest.mark.parametrize(
    "text,kind,found",
    [
        ("juan arroba ejemplo punto com", "email", "juan arroba ejemplo punto com"),
        ("hans at beispiel punkt de", "email", "hans at beispiel punkt de"),
        ("écrire à luc.martin [arobase] exemple (point) fr !", "email", "luc.martin [arobase] exemple (point) fr"),
        ("eva klammeraffe post.example.de", "email", "eva klammeraffe post.example.de"),
        ("tel plus trois trois six un deux trois quatre cinq six sept huit fin", "phone", "plus trois trois six un deux trois quatre cinq six sept huit"),
        ("llame al más tres cuatro seis uno dos tres cuatro cinco seis siete ocho", "phone", "más tres cuatro seis uno dos tres cuatro cinco seis siete ocho"),
        ("plus vier neun eins fünf eins zwei drei vier fünf sechs sieben", "phone", "plus vier neun eins fünf eins zwei drei vier fünf sechs sieben"),
        ("eins neun zwei punkt eins sechs acht punkt null punkt eins", "ip", "eins neun zwei punkt eins sechs acht punkt null punkt eins"),
        ("cuatro uno uno uno 1111 1111 uno uno uno uno", "card", "cuatro uno uno uno 1111 1111 uno uno uno uno"),
    ],
)
def test_four_languages(text, kind, found):
    assert (kind, found) in [(k, text[a:b]) for k, a, b in pii.all_spans(text)[1]]


@pytest.mark.parametrize("text", ["un point de vue de six", "dos o tres puntos, un punto", "acht von neun Punkt zwei", "un, deux, trois, quatre", "il est arrivé at home point final"])
def test_prose_in_other_languages_is_left_alone(text):
    assert pii.all_spans(text) == ([], [])


def seconds(text):
    took = []
    for _ in range(3):
        began = time.process_time()
        pii.all_spans(text)
        took.append(time.process_time() - began)
    return min(took)


REPEATED = [
    (lambda n: "a dot " * n), (lambda n: "a (dot) " * n), (lambda n: "one " * n + "onex"), (lambda n: "a at " * n), (lambda n: "a dot b at " * n), (lambda n: "x@y " * n), (lambda n: "a[at]b[dot]" * n),
    (lambda n: "1 dot " * n), (lambda n: "one, " * n), (lambda n: "a." * n + "@"), (lambda n: "joe at b dot com " * n), (lambda n: "+1 415 555 267 one " * n), (lambda n: "ａ" * n + " at "), (lambda n: "4111 1111 1111 111 one " * n),
]


@pytest.mark.parametrize("k", range(len(REPEATED)))
def test_work_is_linear(k):
    """Eight times the text would take 64 times the time if work were quadratic."""
    a, b = seconds(REPEATED[k](5_000)), seconds(REPEATED[k](40_000))
    assert b < 24 * a + 0.1


def slow_addresses(text):
    """Spans of disguised addresses by trying every start and end."""
    atom, dot, at = r"[A-Za-z0-9_%+-]+", rf"(?:{pii._SPOKEN_DOT}|\.)", rf"(?:{pii.AT.pattern})"
    plain = re.compile(rf"{atom}(?:{dot}{atom})*(?P<at>{at})[A-Za-z0-9-]+(?:{dot}[A-Za-z0-9-]+)+", re.I)
    out = []
    for a in range(len(text)):
        if a and text[a - 1] in pii.ATOM:
            continue
        for b in range(len(text), a, -1):
            if m := plain.fullmatch(text, a, b):
                out.append((a, b, m))
                break
    return out


@given(st.lists(st.sampled_from(["a", "b1", ".", " dot ", "[.]", "@", " arroba ", "(at)", " ", "x-y", ","]), max_size=12).map("".join))
@settings(max_examples=400, deadline=None)
def test_addresses_equal_brute_force(text):
    """Every address found is one by the plain pattern, and a text with exactly one sign and such an address has it found."""
    want = slow_addresses(text)
    for a, b, _ in pii.addresses(text):
        assert any(x <= a and b == y for x, y, _ in want)
    if len(pii.AT.findall(text)) == 1 and want and any(m["at"] != "@" for _, _, m in want):
        assert pii.addresses(text)


@pytest.mark.parametrize("text", ["release 1.2.3. One of them", "pages 12, one of 3", "3 dot 5 and 7 dot 2", "in 2019 one in 4 came"])
def test_digits_in_prose_are_left_alone(text):
    assert pii.all_spans(text) == ([], [])


def test_partial_disguises_are_linear():
    for text in ("1 " * 100_000 + "one", "12345 dot " * 30_000, "1[.]" * 50_000, "one 1" * 50_000, "a at 1 one dot " * 20_000, "1, " * 60_000, "1 one x " * 30_000):
        began = time.process_time()
        pii.all_spans(text)
        assert time.process_time() - began < 20


@pytest.mark.parametrize("text", ["look at foo.com then", "one, two, three and four of them", "meet at noon dot", "5 @ 3.50 each", "from nine to five", "the dot at the end"])
def test_prose_is_left_alone(text):
    assert pii.all_spans(text) == ([], [])


def test_long_runs_are_linear():
    for text in ("1" * 200_000, "a." * 100_000 + "@", "1." * 100_000, "a@" * 100_000, "one " * 50_000, "+1" * 100_000):
        pii.all_spans(text)


def test_odd_rows(docs_of):
    rows = pii.find(docs_of(ODD).withColumn("spans", F.lit(0))).collect()
    assert len(rows) == len(ODD) and all(r.spans == "" and r.n_email == 0 for r in rows)
    assert pii.find(docs_of([])).count() == 0


def test_mask(docs_of):
    docs = docs_of(["mail a@b.co or 10.0.0.1", None, "plain"]).withColumn("extra", F.lit(1))
    rows = pii.mask(docs).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["mail <email> or <ip>", None, "plain"] and rows[0].extra == 1
