import random

from chunklake.llm.decontamination import Matcher, drop_leaks, find_leaks, item_blocks, myers, normalised, places
from tests.llm.conftest import sentence


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern):
        now = [i + 1]
        for j, b in enumerate(text):
            now.append(min(row[j] + (a != b), row[j + 1] + 1, now[-1] + 1))
        row = now
    return min(row)


def test_myers_equals_the_table():
    rng = random.Random(3)
    for _ in range(300):
        pattern = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        found = myers(pattern, text, len(pattern))
        assert (found[0] if found else len(pattern)) == distance(pattern, text)


def edited(rng, text, edits):
    for _ in range(edits):
        k = rng.randrange(len(text))
        text = text[:k] + rng.choice(["", "q", text[k] + "z"]) + text[k + 1 :]
    return text


def test_all_within_the_budget_are_found():
    rng = random.Random(4)
    items = [(n, normalised(sentence(rng, rng.randrange(4, 30)))) for n in range(30)]
    matcher = Matcher(items)
    for item_id, item in items:
        budget = int(0.08 * len(item))
        text = normalised(f"{sentence(rng, 40)} {edited(rng, item, rng.randrange(budget + 1))} {sentence(rng, 40)}")
        expected = {(i, distance(t, text)) for i, t in items if distance(t, text) <= int(0.08 * len(t))}
        assert {(i, d) for i, d, *_ in matcher.find(text)} == expected and item_id in {i for i, _ in expected}


def test_places_of_hits(spark, documents):
    benchmark = spark.createDataFrame([(1, "The quick, brown fox jumps over the lazy dog"), (2, "short"), (3, None), (None, "x"), (4, "?!")], "item_id bigint, text string")
    docs = documents([(1, "É İ — THE quick brown\nfox jumps over the lazy dog!"), (2, "a quick brown cat"), (3, "Short!"), (4, "short of"), (5, None), (5, "")])
    rows = find_leaks(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in rows) == [(1, 1, 0), (3, 2, 0), (4, 2, 0)]
    hit = next(r for r in rows if r["doc_id"] == 1)
    assert "É İ — THE quick brown\nfox jumps over the lazy dog!"[hit["start"] : hit["end"]] == "THE quick brown\nfox jumps over the lazy dog"
    assert sorted(r["doc_id"] for r in drop_leaks(docs, benchmark).collect()) == [2, 5, 5]


def test_items_of_every_size_equal_brute_force(spark, documents):
    rng = random.Random(9)
    letters = "ab c"
    items = {n: normalised("".join(rng.choice(letters) for _ in range(rng.randrange(3, 31)))) or "a" for n in range(60)}
    rows = [(k, "".join(rng.choice(letters) for _ in range(rng.randrange(200)))) for k in range(60)]
    rows += [(100 + n, f"so, {item.upper()}! and") for n, item in items.items()] + [(200 + n, f"so{item}s") for n, item in items.items()]
    benchmark = spark.createDataFrame(list(items.items()), "item_id bigint, text string")

    def holds(text, item):
        if len(item) < 20:
            return f" {item} " in f" {text} "
        return distance(item, text) <= int(0.08 * len(item))

    expected = {(k, n) for k, text in rows for n, item in items.items() if holds(normalised(text), item)}
    assert {(r["doc_id"], r["item_id"]) for r in find_leaks(documents(rows), benchmark).collect()} == expected
    assert {k for k, _ in rows} - {k for k, _ in expected} == {r["doc_id"] for r in drop_leaks(documents(rows), benchmark).collect()}


def test_items_without_an_id(spark, documents):
    text = "A question that has no number but many words"
    benchmark = spark.createDataFrame([(None, text), (None, f"Also {text} twice"), (5, text)], "item_id bigint, text string")
    docs = documents([(1, f"See: {text}."), (2, "nothing of it")])
    found = find_leaks(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"] or 0, r["distance"]) for r in found) == [(1, 0, 0), (1, 5, 0)]
    assert [r["doc_id"] for r in drop_leaks(docs, benchmark.filter("item_id IS NULL")).collect()] == [2]


def test_blocks_of_items(spark, documents):
    rng = random.Random(6)
    items = [(n, sentence(rng, 9)) for n in range(40)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    blocks = list(item_blocks(benchmark, 500))
    assert len(blocks) > 3 and sorted(i for b in blocks for i, _ in b) == list(range(40))


def test_odd_rows_and_empty_tables(spark, documents, odd_rows):
    benchmark = spark.createDataFrame([(7, odd_rows[0][1])], "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = documents(odd_rows, ", item_id string, start int", ("x", 1))
    assert sorted(r["doc_id"] for r in find_leaks(docs, benchmark).collect()) == [1, 2]
    kept = drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows) - 2
    assert find_leaks(docs, none).count() == 0 and drop_leaks(docs, none).count() == len(odd_rows)
    assert find_leaks(documents([]), benchmark).count() == 0


def test_places_follow_the_text():
    text = "Áb, İstanbul\tx"
    assert "".join(text[i].lower() if n != " " else " " for n, i in zip(normalised(text), places(text), strict=True))[:2] == "áb"
