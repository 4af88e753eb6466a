import re

from tallyhouse.llm import pii

TEXTS = [
    "mail a.b@c.de, x@y, p@q.r_s@t.uv and @nobody a@b.c.d-e.f", "ip 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.3.255 1..2.3.4", "card 4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111 4111  1111",
    "+1 (555) 123-4567, + 1 555, +12, +4930123456789. ++49 30 1234 5678 -", "", "plain", "é 4041894974608795 ü @", "9" * 300, "a@" * 50 + "b.c", "+1" * 40,
]


def slow(text):
    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern in ((2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (14 <= len(digits) <= 19 and luhn(digits)) if kind == 2 else 10 <= len(digits) <= 15:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_match_the_patterns():
    import random

    rng = random.Random(5)
    for text in TEXTS + ["".join(rng.choice("a1.@+- ()9") for _ in range(60)) for _ in range(3000)]:
        assert pii.base_spans(text) == slow(text), text


def test_a_repeated_number_without_its_plus_is_found(documents):
    filler = "some words stand here between the two mentions "
    rows = [(i, f"{filler} call +49 30 1234567{i % 10}{i % 7}, {filler}" + "mail me at jo.doe7@mail.org today") for i in range(60)]
    rows += [(100, f"write to jo.doe7@mail.org now. {filler * 3} again jo.doe7@mail is the name"), (101, None), (102, ""), (103, "year 1999, page 12")]
    docs = documents(rows)
    got = {r.doc_id: r for r in pii.find(docs, pii.train(docs)).collect()}
    assert len(got) == len(rows)
    assert [s.kind for s in got[100].base] == ["email"] and {s.kind for s in got[100].added} <= {"email"}
    assert got[101].base == got[102].base == got[103].base == [] and got[103].added == []


def test_messages_carry_a_label_over_a_distance():
    """A token that its own shape leaves open takes the label of its distant twin, and none without a twin."""
    model = pii.np.full((pii.SHAPES, 5), 0.01)
    model[:, 0] = 0.6
    model[:, 1] = 0.38
    skip = pii.np.full((5, 5), 0.002)
    pii.np.fill_diagonal(skip, 0.99)
    text = "jo.doe7@mail.org " + "word " * 50 + "jo.doe7@mail " + "word " * 9 + "un.re7@lated"
    graph = pii.Graph()
    graph.add(0, text, pii.base_spans(text))
    belief = pii.infer(graph, model, pii.np.ones((5, 5)), skip)
    assert belief[:, 1].round(1).tolist()[:2] == [1.0, 1.0] and belief[2].argmax() == 0


def test_empty_table_and_edge_cases(documents, edge_cases):
    docs = documents(edge_cases)
    assert pii.find(docs, pii.train(docs)).count() == len(edge_cases)
    assert pii.find(documents([]), pii.train(documents([]))).count() == 0
