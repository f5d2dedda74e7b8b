"""Spans and redaction against plain Python, also for texts with very many matches."""

import random
import re
import time

from assaymill.llm import secrets


def pieces(rng, n):
    kinds = (
        lambda: "".join(rng.choices("0123456789abcdef", k=rng.choice((15, 16, 17, 24, 40)))),
        lambda: "AKIA" + "".join(rng.choices("ABCDEFGHIJ0123456789", k=rng.choice((13, 14, 20)))),
        lambda: "token=" + "".join(rng.choices("abcXYZ019+/", k=rng.choice((11, 12, 40)))),
        lambda: "".join(rng.choices("abcdefghXYZ0123456789+/", k=40)) + "/" + "".join(rng.choices("0123456789abcdef", k=20)),
        lambda: rng.choice(("über", "plain", "x", "日本")),
    )
    return rng.choice((" ", ", ", "\n", "/")).join(rng.choice(kinds)() for _ in range(n))


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]{14,}", text)]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]{16,}", text)])


def cut(text, spans):
    at, out = 0, []
    for begin, _, end in spans:
        if begin >= at:
            out += [text[at:begin], secrets.REDACTED]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_spans_and_redaction_equal_plain_python(spark):
    rng = random.Random(11)
    texts = [pieces(rng, n) for n in (1, 2, 3, 7, 127, 128, 129, 300, 700) for _ in range(2)] + ["", None, "nothing"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [tuple(s) for s in r.s] for r in secrets.find(df, into="s").select("doc_id", "s").collect()}
    redacted = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    for i, text in enumerate(texts):
        spans = found[i]
        assert spans == sorted(spans)
        assert [s for s in spans if s[1] < 3] == base_spans(text or "")
        covered = {p for b, k, e in spans if k < 3 for p in range(b, e)}
        extra = [p for b, k, e in spans if k == 3 for p in range(b, e)]
        assert len(extra) == len(set(extra)) and covered.isdisjoint(extra)
        assert redacted[i] == (None if text is None else cut(text, spans))
    assert any(k == 3 for spans in found.values() for _, k, _ in spans)


def test_one_text_with_very_many_matches(spark):
    rng = random.Random(7)
    runs = ["".join(rng.choices("0123456789abcdef", k=16)) for _ in range(40_000)]
    df = spark.createDataFrame([(1, " ".join(runs))], "doc_id long, text string")
    began = time.time()
    row = secrets.report(df).first()
    assert row.n_hex == len(runs) and row.spans.endswith(f"hex:{17 * 39_999}:{17 * 40_000 - 1}")
    assert secrets.redact(df).first().text == " ".join([secrets.REDACTED] * len(runs))
    assert time.time() - began < 90
