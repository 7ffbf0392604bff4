import random

from conftest_llm import EDGES
from roadflow.llm import decontaminate

SCHEMA = "item_id long, text string, doc_id long, key string"


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 0, "k") for i, t in rows], SCHEMA)


def planted():
    rng = random.Random(8)

    def prose(n, tag):
        return [f"{tag}{rng.randint(0, 400)}" for _ in range(n)]

    items = [(k, prose(rng.randint(14, 60), "b")) for k in range(30)] + [(90, prose(6, "s")), (91, prose(3, "t"))]
    rows, leaks = [], set()
    for k in range(200):
        words = prose(rng.randint(0, 200), "d")
        if k % 4 == 0:
            item, own = rng.choice(items[:30])
            own = list(own)
            if k % 8 == 0 and len(own) > 30:
                for at in range(7, len(own), 11):
                    own[at] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = own
            leaks.add((k, item))
        if k % 50 == 1:
            words += items[30][1]
            leaks.add((k, 90))
        rows.append((k, " ".join(w.capitalize() if rng.random() < 0.2 else w for w in words)))
    return items, rows, leaks


def test_planted_passages_are_found_and_others_left(spark, docs_of):
    items, rows, leaks = planted()
    benchmark = items_of(spark, [(k, " ".join(w)) for k, w in items])
    found = decontaminate.overlaps(docs_of(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == leaks and len(found) == len(leaks)
    kept = decontaminate.without_overlaps(docs_of(rows), benchmark)
    assert kept.columns == docs_of(rows).columns
    assert {r.doc_id for r in kept.collect()} == {k for k, _ in rows} - {k for k, _ in leaks}


def test_blocks_give_the_same(spark, docs_of):
    items, rows, leaks = planted()
    benchmark = items_of(spark, [(k, " ".join(w)) for k, w in items])
    few = decontaminate.overlaps(docs_of(rows), benchmark, block_words=1500).collect()
    assert {(r.doc_id, r.item_id) for r in few} == leaks
    assert decontaminate.without_overlaps(docs_of(rows), benchmark, 1500).count() == len(rows) - len({k for k, _ in leaks})


def test_every_whole_item_in_the_documents_is_found(spark, small):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = small.select("doc_id", "text").collect()
    whole = {(d.doc_id, b.item_id) for d in texts for b in benchmark.collect() if b.text in d.text}
    assert whole and whole <= {(r.doc_id, r.item_id) for r in decontaminate.overlaps(small, benchmark).collect()}


def test_edges(spark, docs_of):
    item = " ".join(f"q{i}" for i in range(20))
    benchmark = items_of(spark, [(1, item), (1, item), (2, None), (3, ""), (None, "a b " * 30)])
    rows = EDGES + [(50, f"before {item} after"), (50, f"before {item} after"), (51, " ".join(item.split()[:12]))]
    found = decontaminate.overlaps(docs_of(rows), benchmark).collect()
    assert sorted((r.doc_id, r.item_id or 0, r.first_word) for r in found if r.doc_id == 50) == [(50, 1, 1)] * 4
    assert {r.doc_id for r in found} == {6, 50}
    assert decontaminate.overlaps(docs_of(rows), items_of(spark, [])).count() == 0
    assert decontaminate.without_overlaps(docs_of(rows), items_of(spark, [])).count() == len(rows)
    assert decontaminate.overlaps(docs_of([]), benchmark).count() == 0


def best_overlaps(rows, items):
    """Most equal words of every document and item over all diagonals, and the fewest changed words among the item's."""
    out = {}
    for k, words in rows:
        for i, own in items:
            need = min(13, -(-4 * len(own) // 5))
            for origin in range(1 - len(own), len(words)):
                low, high = max(0, origin), min(len(words), origin + len(own))
                equal = [words[p] == own[p - origin] for p in range(low, high)]
                most = sum(equal)
                if len(own) > 16:
                    score = best = matched = most = 0
                    for e in equal:
                        score, matched = (score + 1, matched + 1) if e else (score - 3, matched)
                        if score <= 0:
                            score = matched = 0
                        if score > best:
                            best, most = score, matched
                if most >= need:
                    old = out.get((k, i), (0, len(own)))
                    out[k, i] = (max(old[0], most), min(old[1], len(own) - sum(equal)))
    return out


def test_against_all_diagonals(spark, docs_of):
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(7)]
    items = [(k, [rng.choice(vocabulary) for _ in range(5 + k % 20)]) for k in range(40)]
    rows = []
    for k in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        if k % 2:
            own = list(rng.choice(items)[1])
            own[rng.randrange(len(own))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = own
        rows.append((k, words))
    wanted = best_overlaps(rows, items)
    benchmark = items_of(spark, [(i, " ".join(own)) for i, own in items])
    found = decontaminate.overlaps(docs_of([(k, " ".join(w)) for k, w in rows]), benchmark).collect()
    got = {(r.doc_id, r.item_id): r.n_equal for r in found}
    assert len(got) == len(found) and set(got) <= set(wanted)
    assert all(n <= wanted[pair][0] for pair, n in got.items())
    sure = {pair for pair, (_, changed) in wanted.items() if changed <= 1}
    assert len(sure) >= 60 and sure <= set(got)


def test_one_changed_word_anywhere_is_tolerated():
    for n in range(5, 40):
        own = [f"q{k}" for k in range(n)]
        block = decontaminate.Block([1], [" ".join(own)])
        for at in range(n):
            text = "before it " + " ".join([*own[:at], "changed", *own[at + 1 :]]) + " after"
            data, offsets = decontaminate.text_bytes(decontaminate.pa.array([text, "other words"]))
            (found,) = block.overlaps(data, offsets)
            assert found[:2] == (0, 0) and found[2] >= min(13, n - 1)


def test_scripts_without_spaces_are_cut_into_characters(spark, docs_of):
    chinese, japanese, thai = "快速的棕色狐狸跳过了那只懒狗", "吾輩は猫である。名前はまだ無い", "สุนัขจิ้งจอกสีน้ำตาลกระโดด"
    rare = "".join(chr(0x20000 + 7 * k) for k in range(12))
    korean = "빠른갈색여우가게으른개를뛰어넘는다"
    benchmark = items_of(spark, list(enumerate([chinese, japanese, thai, rare, "四字成語", korean, "Q1 说明以下问题的答案 now"])))
    rows = [
        (0, f"前文。{chinese}后面还有别的内容"),
        (1, f"text before{japanese}after"),
        (2, f"ก่อน{thai}"),
        (3, f"x{rare}y"),
        (4, "四字成語"),
        (5, f"{korean} one two three four five"),
        (6, f"{chinese[:6]}大{chinese[7:]}"),
        (7, "完全不同的一段中文文字没有任何重叠"),
        (8, "q1说明以下问题的答案now"),
        (9, "plain words without any of it"),
    ]
    found = decontaminate.overlaps(docs_of(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(0, 0), (1, 1), (2, 2), (3, 3), (6, 0), (8, 6)}
    kept = decontaminate.without_overlaps(docs_of(rows), benchmark).collect()
    assert {r.doc_id for r in kept} == {4, 5, 7, 9}
