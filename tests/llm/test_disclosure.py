"""Personal data and disclosing terms against the patterns as stated and a plain count of segments."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from ordermart.llm import queries
from ordermart.llm.disclosure import (
    BASE, BITS, CLASSES, SEGMENT, SHARE, SUPPORT, base_spans, entity, luhn, personal_data, sanitise, term_class,
)

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = True
            if name == "ip":
                ok = all(int(p) <= 255 for p in m.group().split("."))
            if name == "card":
                double = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
                ok = 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in double) % 10 == 0
            if name == "phone":
                ok = 9 <= len(digits) <= 15
            if ok:
                found.append((kind, *m.span()))
    return found


@settings(max_examples=1500, deadline=None)
@given(st.text("a@.-1 0+(9é", max_size=40) | st.text("0123456789 -.+()", max_size=60))
def test_spans_are_those_of_the_patterns(text):
    assert base_spans(text) == plain_spans(text)


def test_spans_of_planted_values_and_long_texts():
    text = "Ä x.y+z@mail.example.com, 10.0.0.255, 10.0.0.256, 4111 1111 1111-1111, +1 (663) 555-6869, 4111111111111112"
    assert base_spans(text) == plain_spans(text) and len(base_spans(text)) == 4
    for long in ("a" * 300_000 + "@", "1" * 300_000, "1." * 200_000, "+1" + " " * 300_000, "a@" * 100_000, "@b.c" * 50_000):
        base_spans(long)
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def segments_of(text):
    out = []
    for line in text.split("\n"):
        tokens = list(re.finditer(r"[^\W_]+", line))
        out += [(line, tokens[i:i + SEGMENT]) for i in range(0, len(tokens), SEGMENT)]
    return out


def plain_disclosing(texts):
    """{(entity, term): {class: told enough}} by counting segments one by one."""
    n, n_term, n_entity, n_both, wordings, total = 0, Counter(), Counter(), Counter(), defaultdict(set), 0
    for text in texts:
        spans = plain_spans(text)
        offset = 0
        for line in text.split("\n"):
            tokens = [(m.start() + offset, m.end() + offset, m.group()) for m in re.finditer(r"[^\W_]+", line)]
            tokens_low = [t[2].lower() for t in tokens]
            for low in range(0, len(tokens), SEGMENT):
                seg = tokens[low:low + SEGMENT]
                total += 1
                for t in {t[2].lower() for t in seg} | {f"\0{CLASSES[term_class(t[2])]}" for t in seg}:
                    n_term[t] += 1
                here = set()
                for kind, a, b in spans:
                    inside = [t for t in tokens if t[0] < b and t[1] > a]
                    if inside and inside[0] in seg:
                        here.add(entity(kind, text[a:b]))
                for c in here:
                    n_entity[c] += 1
                    own = set()
                    for i, t in enumerate(seg):
                        if any(t[0] < b and t[1] > a for _, a, b in spans):
                            continue
                        around = [*tokens_low, "\n"]
                        at = low + i
                        before = around[at - 1] if at else "\n"
                        wordings[c, t[2].lower()].add((before, t[2].lower(), around[at + 1]))
                        own |= {t[2].lower(), f"\0{CLASSES[term_class(t[2])]}"}
                    for t in own:
                        n_both[c, t] += 1
            offset += len(line) + 1

    def tells(c, t):
        if not n_both[c, t]:
            return False
        told = math.log2(n_both[c, t] / n_term[t] * total / n_entity[c])
        return told >= SHARE * math.log2(total / n_entity[c]) and told >= BITS

    return {
        (c, t): {k: tells(c, f"\0{k}") for k in CLASSES}
        for c, t in list(n_both) if not t.startswith("\0") and len(wordings[c, t]) >= SUPPORT and tells(c, t)
    }


def plain_all(text, disclosing):
    spans = plain_spans(text)
    held = {entity(k, text[a:b]) for k, a, b in spans}
    terms = []
    for m in re.finditer(r"[^\W_]+", text):
        if not any(m.start() < b and m.end() > a for _, a, b in spans):
            found = [disclosing[c, m.group().lower()] for c in held if (c, m.group().lower()) in disclosing]
            if found:
                terms.append((4 + any(f[CLASSES[term_class(m.group())]] for f in found), *m.span()))
    return spans + sorted(terms)


def corpus(seed, n=400):
    rng = random.Random(seed)
    plain = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    people = [("Quentin Zabriskie", "q.zab@mail.example.com"), ("Odalys", "+1 (663) 555-6869"), ("unit 77x", "10.1.2.3")]
    texts = []
    for i in range(n):
        lines = [" ".join(rng.choices(plain, k=rng.randrange(1, 90))) for _ in range(rng.randrange(1, 4))]
        if i % 20 == 0:
            name, value = people[i // 20 % 3]
            words = rng.choices(plain, k=6)
            lines.append(f"{' '.join(words[:2])} {name}, {words[3]} {value} {' '.join(words[4:])}")
            if i % 40 == 0:
                lines.append(f"{words[0]} {name.upper()} {words[1]}")
        texts.append("\n".join(lines))
    return texts


def test_disclosing_terms(spark):
    texts = corpus(3)
    texts += [texts[0], texts[0], None, "", "İ q.zab@mail.example.com ẞ", "w " * 30_000 + "10.1.2.3 alone"]
    rows = [(None if i == 5 else i // 2 * 2, t, "x", i) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans string, key int").repartition(4)
    disclosing = plain_disclosing([t or "" for t in texts])
    assert {t for _, t in disclosing} >= {"quentin", "zabriskie", "odalys", "77x"}
    expected = [(r[0], plain_all(r[1] or "", disclosing)) for r in rows]
    names = [*BASE, "term", "removed"]
    found = [(r["doc_id"], [(names.index(s["kind"]), s["start"], s["end"]) for s in r["spans"]]) for r in personal_data(frame).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert any(k == 4 for _, spans in found for k, *_ in spans)

    clean = {r["key"]: r for r in sanitise(frame).collect()}
    assert len(clean) == len(rows) and list(clean[0].asDict()) == ["doc_id", "text", "spans", "key"]
    for _, text, _, i in rows:
        if not plain_all(text or "", disclosing):
            assert clean[i]["text"] == text
        else:
            assert not plain_spans(clean[i]["text"]) and "zabriskie" not in clean[i]["text"].lower()
    assert "[email]" in clean[0]["text"]
    assert any(f"[{c}]" in (r["text"] or "") for r in clean.values() for c in CLASSES)


def test_copies_of_a_text_disclose_nothing(spark):
    text = "rare words stand beside someone@mail.example.com here"
    rows = [(i, text) for i in range(40)] + [(100 + i, f"other line {i} of plain text") for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kinds = {s["kind"] for r in personal_data(frame).collect() for s in r["spans"]}
    assert kinds == {"email"}


def test_empty_tables(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert personal_data(frame).collect() == [] and sanitise(frame).collect() == []


def test_the_query(spark, tmp_path):
    texts = [*corpus(1, 200), None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    disclosing = plain_disclosing([t or "" for t in texts])
    names = [*BASE, "term", "removed"]
    found = {r["doc_id"]: r for r in queries.op12_information_sanitisation(spark, str(tmp_path)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        spans = plain_all(text or "", disclosing)
        assert [found[i][f"n_{k}"] for k in BASE] == [sum(s[0] == j for s in spans) for j in range(4)]
        base = ",".join(f"{names[k]}:{a}:{b}" for k, a, b in spans if k < 4)
        assert found[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert found[i]["spans"] == ",".join(f"{names[k]}:{a}:{b}" for k, a, b in spans)
