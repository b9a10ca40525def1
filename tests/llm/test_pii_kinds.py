"""All kinds of personal data against plain Python, and texts with very many of them."""

import random
import re
import time

import pytest

from meterwatch.llm import pii


def luhn(digits):
    total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def mod97(value):
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def plain(text):
    """(kind, start, stop) of all kinds by the patterns as they are described, context within 40 characters before."""
    def near(at, words):
        return re.search(rf"\b(?:{words})", text[max(at - 40, 0) : at].lower())

    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(d := re.sub(r"\D", "", m[0])) <= 19 and luhn(d)]
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
    iban = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
    for m in re.finditer(iban, text):
        tries = [m[0], re.sub(r" [A-Z0-9]{1,4}$", "", m[0])]
        tries.append(re.sub(r" [A-Z0-9]{1,4}$", "", tries[1]))
        good = [t for t in tries if len(t.replace(" ", "")) >= 15 and mod97(t)]
        if good:
            found.append(("iban", m.start(), m.start() + len(good[0])))
    for m in re.finditer(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])", text):
        if m[1] not in ("000", "666") and m[1][0] != "9" and m[2] != "00" and m[3] != "0000" and near(m.start(), "ssn|social security|taxpayer"):
            found.append(("ssn", *m.span()))
    for m in re.finditer(r"(?<![0-9A-Za-z.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])", text):
        if near(m.start(), "phone|tel|telephone|call|mobile|fax"):
            found.append(("local_phone", *m.span()))
    return found


PARTS = [
    "mail a.b@c.de", "x@y.z", "10.0.0.1", "300.1.1.1", "4539 1488 0343 6467", "4539148803436467", "1234567890123", "+49 30 1234-5678", "+1 (2) 3",
    "DE89 3704 0044 0532 0130 00", "BE68 5390 0754 7034 PAID", "PAID", "GB82WEST12345698765432", "ssn 123-45-6789", "123-45-6789", "666-45-6789", "call (555) 123-4567", "555-123-4567",
    "tel.", "ünïcode", "a", ",", "\n", "7", "host", "💩", "phone",
]


def test_all_kinds_as_plain_python(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) + rng.choice([" ", "  ", "\t"]) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    # over several blocks of hits
    texts += [" ".join(rng.choice(PARTS) for _ in range(n)) for n in (900, 3000)]
    order = [k.name for k in pii.KINDS]
    got = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "pii").collect()
    for r in got:
        want = sorted(plain(texts[r.doc_id]), key=lambda x: (order.index(x[0]), x[1]))
        assert [(x.kind, x.start, x.stop) for x in r.pii] == want
        assert all(texts[r.doc_id][x.start : x.stop] == x.value for x in r.pii)


def redacted(text, spans):
    out, at = "", 0
    for start, _, kind, stop in sorted((a, -b, k, b) for k, a, b in spans):
        if start >= at:
            out += text[at:start] + f"<{kind.upper()}>"
        at = max(at, stop)
    return out + text[at:]


def test_redaction_of_many_spans(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(PARTS) for _ in range(n)) for n in (0, 1, 5, 40, 700, 2500)]
    got = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == redacted(t, plain(t))


@pytest.mark.parametrize("act", ["find", "redact"])
def test_a_hundred_thousand_hits_in_one_text(spark, act):
    frame = spark.range(1).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 100000), i -> concat('mail user', i, '@host', i % 7, '.example.com ')), '') AS text")
    start = time.time()
    if act == "find":
        assert pii.find_pii(frame).selectExpr("size(pii) AS n").first().n == 100_000
    else:
        assert pii.redact(frame).selectExpr("length(text) AS n").first().n == 100_000 * len("mail <EMAIL> ")
    assert time.time() - start < 30
