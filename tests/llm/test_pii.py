"""Personal data against plain Python: formats, positions and the bootstrapped graph."""

import hashlib
import random
import re
from collections import defaultdict

from strataloom.llm import pii
from strataloom.llm.queries import QUERIES

BASE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARKS = "\"'([{<>)]},.;:!?*#$%&|="


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def base(text):
    return [
        (k, m.start(), m.end())
        for k, (kind, rx) in enumerate(BASE)
        for m in rx.finditer(text or "")
        if valid(kind, m.group())
    ]


def candidates(text):
    words = [(m.start(), m.group()) for m in WORD.finditer(text or "")]
    out = []
    marked = [bool(re.search("[0-9@]", w)) for _, w in words]
    for k, (at, w) in enumerate(words):
        bare = w.lstrip(MARKS)
        token = bare.rstrip(MARKS)
        if len(re.sub("[^0-9]", "", token)) < 4 and "@" not in token:
            continue
        start = at + len(w) - len(bare)
        # words between the neighbouring words with digits, as far as 64 code points reach
        lo = max((words[j][0] + len(words[j][1]) for j in range(k) if marked[j]), default=0)
        hi = min((words[j][0] for j in range(k + 1, len(words)) if marked[j]), default=len(text))
        left = WORD.findall(text[max(lo, at - 64) : at].lower())
        right = WORD.findall(text[at + len(w) : min(hi, at + len(w) + 64)].lower())
        shape = re.sub("[0-9]", "9", re.sub(r"[^\W\d_]+", "a", token))
        patterns = [f"shape\t{shape}"]
        if len(left) > 1:
            patterns.append(f"words\t{left[-2]} {left[-1]}")
        if left:
            patterns.append(f"left\t{left[-1]}\t{shape}")
        if right:
            patterns.append(f"right\t{right[0]}\t{shape}")
        out.append((start, start + len(token), token.lower(), patterns))
    return out


def rebuilt(texts, rounds=3, sure=0.8, support=5, doubt=1.0):
    """Spans of each distinct text."""
    seeds_of, members, free = defaultdict(set), defaultdict(set), []
    for text in set(texts):
        own = base(text)
        for start, end, token, patterns in candidates(text):
            kinds = [k for k, a, b in own if a < end and b > start]
            if kinds:
                seeds_of[token].add(min(kinds))
            else:
                free.append((text, start, end, patterns))
            for p in patterns:
                members[p].add(token)
    known = {(t, k): 1.0 for t, ks in seeds_of.items() for k in ks}
    instances = dict(known)
    for r in range(rounds):
        conf, firm = {}, {}
        for p, tokens in members.items():
            for k in range(4):
                mass = [instances[t, k] for t in tokens if (t, k) in instances]
                if mass:
                    conf[p, k], firm[p, k] = sum(mass) / (len(tokens) + doubt), sum(c >= 0.5 for c in mass)
        if r + 1 < rounds:
            instances = dict(known)
            for (p, k), c in conf.items():
                if firm[p, k] >= support:
                    for t in members[p]:
                        if t not in seeds_of:
                            instances[t, k] = max(instances.get((t, k), 0), c)
    added = defaultdict(list)
    for text, start, end, patterns in free:
        best = max(
            ((c, -k) for p in patterns for k in range(4) if (c := conf.get((p, k), 0)) >= sure and firm[p, k] >= support),
            default=None,
        )
        if best:
            added[text].append((-best[1], start, end))
    return {t: (base(t), sorted(added[t])) for t in set(texts)}


def shown(spans):
    return ",".join(f"{BASE[k][0]}:{a}:{b}" for k, a, b in sorted(spans))


def test_query_against_plain_rebuild(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = rebuilt(list(texts.values()))
    got = QUERIES["op5_pii"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        own, added = want[texts[r["doc_id"]]]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in own) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(shown(own).encode()).hexdigest()
        assert r["spans"] == shown(own + added) and r["n_added"] == len(added)


def test_formats_on_random_strings(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("aé1234567890@.-+ ()_%\n" + "1" * k, k=rng.randrange(120))) for k in range(20) for _ in range(60)]
    texts += ["a@b.c_d@e.f", "a@b.c@d.e", "x" * 30_000, "1" * 20_000, "1.2.3.4.5.6.7.8", "300.1.1.1 000000000000000000000000255.1.1.1",
              "+1 (132) 555-1352 4111 1111 1111 1111-2", "4111111111111111", "+" * 50, "a@" * 4000, "a@b." * 4000, "é🙂 a@b.co 漢 1.1.1.1"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.spans(docs).collect():
        assert [tuple(s) for s in r["seeds"]] == base(texts[r["doc_id"]]), texts[r["doc_id"]][:200]


def made():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    rows = []
    for k in range(60):
        phone = f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}" if k % 2 else f"555-{rng.randrange(1000, 9999)}"
        rows.append((k, " ".join(rng.choices(words, k=9)) + f" call me {phone}, " + " ".join(rng.choices(words, k=4))))
    rows.append((100, "order 12345-77 of year 2024"))
    return rows


def test_unseen_identifiers_and_odd_rows(spark):
    rows = made()
    odd = [(200, None), (200, ""), (None, "call me 555-1234"), (0, rows[0][1]), (0, "call me 555-9999 again"), (201, "w " * 50_000 + "a@b.co")]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows + odd], "doc_id long, text string, seeds string, added int")
    got = pii.spans(docs).collect()
    want = rebuilt([t or "" for _, t in rows + odd])
    assert len(got) == len(rows) + len(odd)
    have = sorted((str(r["doc_id"]), [tuple(s) for s in r["seeds"]], [tuple(s) for s in r["added"]]) for r in got)
    assert have == sorted((str(i), *want[t or ""]) for i, t in rows + odd)
    assert all(want[t][1] for i, t in rows if i % 2 == 0 and i < 60) and not want[rows[-1][1]][1]
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.count() == len(got)
    texts = [r["text"] for r in clean.collect()]
    assert texts.count(None) == 1 and "" in texts
    assert not any(re.search("555-", t or "") for t in texts) and "order 12345-77 of year 2024" in texts
    assert any(t and t.endswith("w [EMAIL]") for t in texts)
    empty = docs.limit(0)
    assert pii.spans(empty).count() == 0 and pii.redact(empty).count() == 0


def test_overlaps_are_replaced_once(spark):
    docs = spark.createDataFrame([(1, "a 4111111111111111@b.co z +1 411 111 1111 q 10.0.0.1")], "doc_id long, text string")
    assert pii.redact(docs).first()["text"] == "a [EMAIL] z [PHONE] q [IP]"
