import hashlib
import math
import random
import re
from collections import Counter

from chunklake.llm.pii import find_personal_data, sanitise
from tests.llm.conftest import sentence

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def digits(value):
    return re.sub("[^0-9]", "", value)


def luhn(number):
    doubled = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


VALID = {
    "email": lambda v: True,
    "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
    "card": lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v)),
    "phone": lambda v: 9 <= len(digits(v)) <= 15,
}


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if VALID[k](m.group())]


def check(rows, frame):
    got = find_personal_data(frame).collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]))
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[1])
    for r in got:
        options = [base(t) for t in texts[r["doc_id"]]]
        spans = r["spans"].split(",") if r["spans"] else []
        own = [s for s in spans if not s.startswith("term")]
        assert own in options
        assert r["base_sha256"] == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k) for s in own) for k in PATTERNS]
    return sorted(got, key=lambda r: key((r["doc_id"], r["spans"])))


def test_base_spans_equal_the_patterns(documents):
    rng = random.Random(1)
    pieces = ["a@b.co", "x.y@b-c.d.e@f.gh", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.0003.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (202) 555-0182",
              "+49", "12 34", "é😀", "\n", " ", "@", "+", "-", ".", "word", "0", "5", "99999999999999999999", "+1.2.3.4.5.6.7.8.9", "a@b", "%@x.y", "4111111111111111", ")", "("]
    rows = [(i, "".join(rng.choice(pieces) + rng.choice(["", " ", ""]) for _ in range(rng.randrange(0, 14)))) for i in range(600)]
    assert sum(len(base(t)) for _, t in rows) > 500
    check(rows, documents(rows))


def test_terms_that_reveal_an_entity(documents):
    rng = random.Random(2)
    rows = [(i, sentence(rng, 20, 60).replace("w", "word").replace("0", "o").replace("1", "i").replace("2", "z")) for i in range(80)]
    rows = [(i, re.sub("[0-9]", "k", t)) for i, t in rows]
    tell = {k: f"{rows[k][1]} call Zanzibar{'i' * (k % 2)} office of ann@corp{k % 2}.com often" for k in range(0, 12)}
    rows = [(i, tell.get(i, t if i % 5 else f"{t} often office")) for i, t in rows]
    rows += [(100 + k, tell[0]) for k in range(5)]
    got = check(rows, documents(rows))
    texts = dict(rows)
    distinct = set(texts.values())
    words = {t: set(re.findall(r"[^\W\d_]+", re.sub(r"\S+@\S+", "", t.lower()))) for t in distinct}
    keys = {t: {k for e in re.findall(r"ann@corp\d\.com", t) for k in (f"email:{e}", "email", e[3:])} for t in distinct}
    pairs = Counter((k, w) for t in distinct for k in keys[t] for w in words[t])
    of_key, of_word = (Counter(x for t in distinct for x in table[t]) for table in (keys, words))
    told, doubtful = set(), set()
    for (k, w), both in pairs.items():
        share = math.log(both * len(distinct) / (of_word[w] * of_key[k])) / math.log(len(distinct) / of_key[k])
        expected = of_word[w] * of_key[k] / len(distinct)
        chance = both - expected - both * math.log(both / expected) + math.log(len(pairs)) - math.log(0.01)
        if both >= 2 and share >= 0.75 and chance <= 0.1:
            (told if chance <= -0.1 else doubtful).add((k, w))
    for r in got:
        text = texts[r["doc_id"]]
        marked = {text[int(s.split(":")[1]) : int(s.split(":")[2])].lower() for s in filter(None, r["spans"].split(",")) if s.startswith("term")}
        expected = {w for w in words[text] for k in keys[text] if (k, w) in told}
        assert expected <= marked <= expected | {w for _, w in doubtful}
    assert {w for _, w in told} >= {"zanzibar", "zanzibari"}
    assert sum("zanzibar" in dict(rows)[r["doc_id"]].lower() and "term" in r["spans"] for r in got) == 17


def test_terms_of_entities_that_belong_to_one_text(documents):
    rng = random.Random(4)
    rows = [(i, sentence(rng, 40, 9000)) for i in range(60)]
    rows = [(i, f"Li Zanzibari {'and so on ' * 30} {t} ann{i}@clinic.org zanzibarix@clinic.org" if i < 5 else f"{t} and so on") for i, t in rows]
    got = check(rows, documents(rows))
    for r in got:
        text = rows[r["doc_id"]][1]
        marked = [text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in filter(None, r["spans"].split(",")) if s.startswith("term")]
        assert [w for w in marked if len(w) > 1 and w[0].isupper()] == (["Li", "Zanzibari"] if r["doc_id"] < 5 else [])
        assert not {"and", "so", "on", "zanzibarix"} & set(marked)


def test_terms_of_chance_are_none(documents):
    """Many texts with entities and words that have nothing to do with each other; then names that go with an entity."""
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(7)) for _ in range(3000)]
    rows = []
    for i in range(600):
        text = [rng.choice(words) for _ in range(50)]
        if i % 4 == 0:
            text.append(rng.choice([f"user{rng.randrange(40)}@site{rng.randrange(9)}.com", f"10.0.{rng.randrange(9)}.{rng.randrange(9)}", "+1 202 555 0182"]))
            text.append("3fab12ce77de")  # letters of a code are no words
        if i % 60 == 0:
            text += ["Quillington", "bo.quill@home.org"]
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
    found = {r["doc_id"]: r["found"] for r in find_personal_data(documents(rows)).collect()}
    terms = [dict(rows)[i][s["start"] : s["end"]] for i, spans in found.items() for s in spans if s["kind"] == "term"]
    assert terms.count("Quillington") == 10 and len(terms) <= 12
    # the same words dealt out anew have nothing to tell
    bag = [w for _, text in rows for w in re.findall(r"[A-Za-z]+", re.sub(r"\S*[@0-9]\S*", "", text))]
    rng.shuffle(bag)
    entities = [re.findall(r"\S*[@0-9]\S*", text) for _, text in rows]
    dealt = [(i, " ".join([*bag[50 * i : 50 * i + 50], *entities[i]])) for i in range(600)]
    found = find_personal_data(documents(dealt)).collect()
    assert sum(s["kind"] == "term" for r in found for s in r["found"]) <= 2


def test_sanitised_text(documents):
    rows = [(1, "Mail a@b.co or +1 202 555 0182, ok"), (2, None), (3, ""), (4, "é a@b.co"), (4, "é a@b.co")]
    got = {(r["doc_id"], r["sanitised"]) for r in sanitise(documents(rows, ", sanitised int", (3,))).collect()}
    assert got == {(1, "Mail [EMAIL] or [PHONE], ok"), (2, None), (3, ""), (4, "é [EMAIL]")}


def test_odd_rows(documents, odd_rows):
    rows = [*odd_rows, (50, "a@b.co " * 300), (51, "1 " * 5000), (52, "+" + "1 " * 3000), (53, "a" * 60000), (54, "x@y.zz" + "." * 3000)]
    check(rows, documents(rows, ", text_id int, base string", (1, "b")))
    assert find_personal_data(documents([])).count() == 0
    assert sanitise(documents(odd_rows)).count() == len(odd_rows)
