from __future__ import annotations

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerline.llm import personal_data as pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True,
        "ip": kind != "ip" or all(int(x) <= 255 for x in value.split(".")),
        "card": 14 <= len(digits) <= 19 and luhn(digits),
        "phone": 10 <= len(digits) <= 15,
    }[kind]


def base_by_force(text):
    found = [
        (m.start(), number, m.end())
        for number, kind in enumerate(PATTERNS)
        for m in re.finditer(PATTERNS[kind], text or "")
        if valid(kind, m[0])
    ]
    return sorted(found)


def test_base_spans_equal_python_regexes(docs_of, odd_rows):
    rnd = random.Random(5)
    parts = ["a", "B", "é", "😀", " ", "\n", ".", "@", "-", "+", "1", "23", "255", "256", "(", ")", "x@y.z", "10.0.0.1",
             "4111 1111 1111 1111", "+1 (988) 555-2485", "_", "%", "00000000000000000000001"]
    rows = [(100 + i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))) for i in range(1500)]
    rows += [r for r in odd_rows if r[0] is not None]
    texts = dict(rows)
    for r in pii.find_personal_data(docs_of(rows)).collect():
        assert [tuple(s) for s in r.base] == base_by_force(texts[r.doc_id]), texts[r.doc_id]


def test_long_runs_are_linear(docs_of):
    text = "a" * 200_000 + " " + "1." * 100_000 + " " + "x@" + "y." * 50_000 + "z"
    found = pii.find_personal_data(docs_of([(1, text)])).first()
    assert found.base[-1].kind == 0 and found.base[-1].end == len(text)


def test_reliable_contexts_find_new_identifiers(docs_of):
    rows = [(i, f"words callme +1 (9{i:02d}) 555-24{i:02d} and more words") for i in range(30)]
    rows += [(50, "please callme 988-555-77 now"), (51, "in year 1999 and year 2001"), (52, "callme 4111111111111112 no")]
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_personal_data(docs_of(rows)).collect()}
    assert found[50] == [(14, 3, 24)]
    assert found[51] == [] and found[52] == []  # a failed check is final
    assert all(len(found[i]) == 1 for i in range(30))


SPACE = " \t\n\r\f\v"


def split_words(text):
    return [w for w in re.split("[ \t\n\r\f\v]+", text) if w]


def contexts(before, after, name):
    words = [*split_words(before), *([name] if name else [])]
    left, left2 = (["", "", *words][-1]).lower(), (["", "", *words][-2]).lower()
    rest = after.lstrip(".,;:!?)]}\"'")
    right = split_words(rest)[0].lower() if rest and rest[0] in SPACE and split_words(rest) else ""
    if not left:
        return []
    return [f"{left} *", *([f"{left2} {left} *"] if left2 else []), *([f"{left} * {right}"] if right else [])]


def matches_with_context(pattern, text):
    found, last = list(re.finditer(pattern, text)), 0
    for m, following in zip(found, [*found[1:], None]):
        yield m, text[last : m.start()], text[m.end() : following.start() if following else len(text)]
        last = m.end()


def spans_by_force(texts, rounds=2, support=3, confidence=0.8):
    """Learned and fixed spans: pairs of spans compared, the graph in dictionaries."""
    instances, base = [], {}
    for doc, text in texts.items():
        good, bad = [], []
        for number, (kind, pattern) in enumerate(PATTERNS.items()):
            for m, before, after in matches_with_context(pattern, text):
                (good if valid(kind, m[0]) else bad).append((m.start(), number, m.end()))
                if valid(kind, m[0]):
                    instances.append((doc, m.start(), m.end(), number, m[0], contexts(before, after, ""), ()))
        base[doc] = good
        for m, before, after in matches_with_context(pii._CANDIDATE, text):
            name = re.match(pii._NAME, m[0])
            name = name[1] if name else ""
            value = m[0][len(name) :].rstrip(".,;:!?)]}\"'")
            start = m.start() + len(name)
            end = start + len(value)
            if value and not any(s < end and start < e for s, _, e in good):
                refused = {k for s, k, e in bad if s < end and start < e}
                instances.append((doc, start, end, None, value, contexts(before, after, name), refused))
    edges = {(p, i[4]) for i in instances for p in i[5]}
    seeds = {(i[4], i[3]): 1.0 for i in instances if i[3] is not None}
    sizes = defaultdict(int)
    for p, _ in edges:
        sizes[p] += 1
    known = dict(seeds)
    for _ in range(rounds):
        hits, strong = defaultdict(float), defaultdict(int)
        for p, v in edges:
            for kind in range(4):
                score = known.get((v, kind))
                if score is not None:
                    hits[p, kind] += score
                    strong[p, kind] += score >= confidence
        patterns = {k: h / (sizes[k[0]] + 1) for k, h in hits.items() if strong[k] >= support}
        miss = {}
        for p, v in edges:
            for kind in range(4):
                if (p, kind) in patterns:
                    miss[v, kind] = miss.get((v, kind), 1.0) * max(1 - patterns[p, kind], 1e-9)
        known = {k: max(1 - miss.get(k, 1.0), seeds.get(k, 0.0)) for k in miss.keys() | seeds.keys()}
    found = {doc: set(spans) for doc, spans in base.items()}
    for doc, start, end, kind, value, occurs, refused in instances:
        digits = len(re.sub("[^0-9]", "", value))
        plausible = [
            bool(re.fullmatch("[^@]+@[^@]+", value)),
            bool(re.search(r"[0-9a-fA-F]+([.:])[0-9a-fA-F]*\1", value)),
            12 <= digits <= 19,
            7 <= digits <= 15 and "@" not in value,
        ]
        votes = [
            (patterns[p, k], -k) for p in occurs for k in range(4)
            if patterns.get((p, k), 0) >= confidence and k not in refused and plausible[k]
        ]
        if kind is None and votes:
            found[doc].add((start, -max(votes)[1], end))
    return {doc: sorted(spans) for doc, spans in found.items()}


def test_learned_spans_equal_brute_force(docs_of):
    rnd = random.Random(11)
    cues = ["contact:", "mail me at", "callme", "tel=", "pay with card", "host", "in the year", "id"]
    values = [
        lambda: f"{rnd.choice('abcdef')}{rnd.choice('ghijk')}.{rnd.choice('lmnop')}@example.com",
        lambda: f"{rnd.choice('abcdef')}{rnd.choice('ghijk')}@localhost",
        lambda: f"+1 (9{rnd.randint(10, 99)}) 555-{rnd.randint(1000, 9999)}",
        lambda: f"{rnd.randint(200, 999)} {rnd.randint(100, 999)} {rnd.randint(1000, 9999)}",
        lambda: f"10.0.{rnd.randint(0, 300)}.{rnd.randint(0, 255)}",
        lambda: f"fe80::{rnd.randint(0, 99)}:1",
        lambda: str(rnd.randint(1900, 2030)),
        lambda: "4111 1111 1111 1111",
        lambda: "4111.2222.3333.4444",
    ]
    likely = {"contact:": (0, 0, 0, 0, 1), "mail me at": (0, 0, 0, 1), "callme": (2, 2, 2, 3), "tel=": (2, 2, 3),
              "pay with card": (7, 8), "host": (4, 4, 4, 5), "in the year": (6,), "id": range(9)}
    texts = {}
    for doc in range(400):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            cue = rnd.choice(cues)
            parts += [rnd.choice(["word", "and", "so é😀", ""]), cue, values[rnd.choice(likely[cue])]() + rnd.choice(["", ".", ",", ")"])]
        texts[doc] = rnd.choice([" ", "  ", "\n"]).join(parts).replace("tel= ", "tel=")
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_personal_data(docs_of(list(texts.items()))).collect()}
    expected = spans_by_force(texts)
    assert found == expected
    assert sum(map(len, expected.values())) > sum(len(base_by_force(t)) for t in texts.values()) + 30


def test_seeds_without_digits_and_spaced_numbers(docs_of):
    rows = [(i, f"please contact: {chr(97 + i % 26)}{chr(97 + i // 26)}.smith@example.com for it") for i in range(30)]
    rows += [(50 + i, f"callme +1 (9{10 + i}) 555-24{10 + i} now") for i in range(30)]
    rows += [(100, "contact: john@localhost"), (101, "callme 555 123 4567, please"), (102, "the john@localhost and 555 123 4567")]
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_personal_data(docs_of(rows)).collect()}
    assert found[100] == [(9, 0, 23)] and found[101] == [(7, 3, 19)] and found[102] == []


def test_many_spans_in_one_text(docs_of):
    texts = {1: "".join(f"mail u{i}@example.com " for i in range(8_000)), 2: "".join(f"mail u{i}@example.com 7{i} " for i in range(32_000))}
    found = {r.doc_id: r.base for r in pii.find_personal_data(docs_of(list(texts.items()))).collect()}
    for doc, text in texts.items():
        assert [(s.start, s.end) for s in found[doc] if s.kind == 0] == [m.span() for m in re.finditer(PATTERNS["email"], text)]


def test_odd_rows(docs_of, odd_rows):
    found = pii.find_personal_data(docs_of(odd_rows))
    assert found.count() == len(odd_rows)
    text = found.select(pii.span_text(F.col("spans")).alias("t"), pii.kind_count(F.col("base"), "ip").alias("n"))
    assert {(r.t, r.n) for r in text.collect()} == {("", 0)}
    assert pii.find_personal_data(docs_of([])).count() == 0
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
