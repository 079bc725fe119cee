from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from ledgerline.llm.line_templates import drop_recurring_lines


def cleaned(df):
    return {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()}


def test_variable_fields_and_small_changes_share_a_template(docs_of):
    long = "we are glad that you have come to this page about {} and its many uses"
    rows = [
        (1, "first document\nprinted on page 12 of 90\n" + long.format("iron") + "\nown words of one"),
        (2, "second document\nprinted on page 3 of 7\n" + long.format("coal") + "\nother words of two"),
        (3, "third document\n" + long.format("gold") + "\nnothing else here now"),
    ]
    assert cleaned(drop_recurring_lines(docs_of(rows))) == {
        (1, rows[0][1], 4, 0),
        (2, "second document\nother words of two", 4, 2),
        (3, "third document\nnothing else here now", 3, 1),
    }


def test_a_threshold_of_documents_and_copies_that_count_once(docs_of):
    rows = [(i, "same line of text\nyes") for i in range(4)] + [(9, "own line of words\nsame line of text")]
    found = cleaned(drop_recurring_lines(docs_of(rows)))
    assert {(9, "own line of words", 2, 1), (0, "same line of text\nyes", 2, 0), (3, "yes", 2, 1)} <= found
    copies = drop_recurring_lines(docs_of(rows[:4]))
    assert all(r.n_dropped == 0 for r in copies.collect())
    assert all(r.n_dropped == 0 for r in drop_recurring_lines(docs_of(rows), min_documents=3).collect())


def test_a_leaf_holds_several_templates(docs_of):
    families = [
        "Click here to read all the other news about {}",
        "Click here to join our free weekly letter on {}",
        "Click here to buy some new cheap things from {}",
    ]
    names = [a + b for a in "bcdfghklmnprst" for b in "ae"][:26]
    rows = [(i * 3 + f, f"{n} own\n" + line.format(n)) for i, n in enumerate(names) for f, line in enumerate(families)]
    found = {r.doc_id: r.n_dropped for r in drop_recurring_lines(docs_of(rows)).collect()}
    assert found == {i: int(i > 2) for i in found} and len(found) == 78


def test_different_lines_with_the_same_beginning_stay(docs_of):
    rows = [(1, "it is a bright cold day today"), (2, "it is a dark warm night again"), (3, "ok\nok\nok")]
    assert all(r.n_dropped == 0 for r in drop_recurring_lines(docs_of(rows)).collect())


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    found = drop_recurring_lines(docs)
    assert set(found.columns) == {*docs.columns, "n_dropped"}
    assert sorted(str(r.text) for r in found.collect()) == sorted(str(t) for _, t in odd_rows)
    assert {r.n_lines for r in found.where("text IS NULL").collect()} == {0}
    assert drop_recurring_lines(docs_of([])).count() == 0


def test_no_python_in_the_plan(docs_of, plan_of):
    plan = plan_of(drop_recurring_lines(docs_of([(1, "a b c")])))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def by_force(rows, depth=3):
    """{(id, text): (kept text, lines, dropped)} worked out line by line."""
    lines, distinct = [], defaultdict(set)
    for doc, text in rows:
        for place, line in enumerate(text.split("\n")):
            tokens = tuple("<*>" if re.search("[0-9]", t) else t for t in re.split("[ \t\r\f\x0b]+", line) if t)
            if len(tokens) >= 3 or len(line.strip(" \t\r\f\x0b")) >= 20:
                lines.append((doc, text, place, tokens))
            if len(tokens) >= 3:
                distinct[len(tokens), tokens[:3]].add(tokens)
    template, groups = {}, {g: m for g, m in distinct.items() if len(m) > 1}
    for level in range(depth + 1):
        children = defaultdict(set)
        for group, members in groups.items():
            n = len(next(iter(members)))
            votes = [Counter(m[i] for m in members) for i in range(n)]
            top = [v.most_common(1)[0] for v in votes]
            common = [t if 2 * c > len(members) else None for t, c in top]
            fits = {m for m in members if sum(a == b for a, b in zip(m, common, strict=True)) >= n * 0.8}
            template |= {m: ("general", group) for m in fits}
            rest, best = members - fits, None
            for i in sorted({3 + k * (n - 3) // min(8, n - 3) for k in range(min(8, n - 3))}):
                weight, all_ = sum(c * c for c in Counter(m[i] for m in rest).values()), len(rest) ** 2
                if weight < all_:
                    parts = 4 * all_ >= 5 * weight
                    best = max(best or (), (parts, weight if parts else -weight, -i))
            for m in rest if best else ():
                children[group, -best[2], m[-best[2]]].add(m)
        groups = {g: m for g, m in children.items() if len(m) > 1}
    found = defaultdict(list)
    for doc, text, place, tokens in lines:
        found[len(tokens), template.get(tokens, tokens)].append((doc, place, text))
    gone = defaultdict(set)
    for places in found.values():
        if len({text for _, _, text in places}) > 1:
            for doc, place, text in sorted(places)[1:]:
                gone[doc, text].add(place)
    out = {}
    for doc, text in rows:
        split = text.split("\n")
        kept = [line for i, line in enumerate(split) if i not in gone[doc, text]]
        out[doc, text] = ("\n".join(kept), len(split), len(gone[doc, text]))
    return out


def crowded(seed):
    """Families of lines with common beginnings, of several sizes, with variable fields and changed words."""
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in "bdfgklmnprst" for b in "aeiou"]
    families = [["see", "all", "our", *rnd.choices(words, k=rnd.choice([4, 9, 9, 9]))] for _ in range(7)]
    rows = []
    for doc in range(120):
        lines = []
        for _ in range(rnd.randint(1, 6)):
            line = list(rnd.choices(families, weights=[30, 20, 8, 4, 2, 1, 1])[0])
            for _ in range(rnd.choice([0, 0, 1, 2])):
                line[rnd.randrange(3, len(line))] = rnd.choice([*words, "7", "x9"])
            lines.append(" ".join(line))
        lines.append(" ".join(["see", "all", "our", *rnd.choices(words, k=9)]))
        lines.append(rnd.choice(["short one", "ok", "unspacedtextofmorethantwentycharacters", ""]))
        rows.append((doc, "\n".join(lines)))
    return rows


def test_tree_equals_brute_force(docs_of):
    for seed in (1, 2):
        rows = crowded(seed)
        found = drop_recurring_lines(docs_of(rows)).collect()
        texts = dict(rows)
        assert {(r.doc_id, texts[r.doc_id]): (r.text, r.n_lines, r.n_dropped) for r in found} == by_force(rows)


def test_unspaced_text_and_short_lines(docs_of):
    passage = "これは多くの文書に繰り返し現れる長い一行の文章です。"
    rows = [(i, f"{c}\n{passage}\nLes.\nAnd so.") for i, c in enumerate("abc")]
    found = {r.doc_id: r.text for r in drop_recurring_lines(docs_of(rows)).collect()}
    assert found == {0: rows[0][1], 1: "b\nLes.\nAnd so.", 2: "c\nLes.\nAnd so."}


def test_long_lines_and_documents_of_many_lines(docs_of):
    rnd = random.Random(7)
    words = [f"w{c}{d}" for c in "abcdefgh" for d in "ijklmnop"]
    long = [rnd.choice(words) for _ in range(5_000)]
    other = [*long[:10], *(rnd.choice(words) for _ in range(4_990))]
    near = [*long]
    near[4_000] = "changed"
    many = "\n".join(f"line of words {a} {b} {c} here" for a in words[:50] for b in words[:50] for c in words[:40])
    rows = [(1, " ".join(long)), (2, " ".join(other)), (3, f"own\n{' '.join(near)}"), (4, many), (5, f"{many}\nlast line of five")]
    found = {r.doc_id: (r.n_lines, r.n_dropped, len(r.text)) for r in drop_recurring_lines(docs_of(rows)).collect()}
    assert found[1][:2] == (1, 0) and found[2][:2] == (1, 0) and found[3] == (2, 1, 3)
    assert found[4][0] == 100_000 and found[5][:2] == (100_001, 100_000)
