"""Decontamination, hard negatives and token alignment against brute force."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallycast.llm import decontamination, hard_negatives, token_alignment
from tallycast.llm.oracles import ORACLES

DOCUMENT = "doc_id long, text string, items string, spans string, pairs long"


def documents(spark, *rows):
    """``(doc_id, text)`` rows with columns whose names clash with results."""
    return spark.createDataFrame([(i, text, "extra", "extra", 7) for i, text in rows], DOCUMENT)


def against_sql(spark, sf_dir, name, query):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    theirs = duck.execute(ORACLES[name]).df()
    ours = query(spark, sf_dir).toPandas()[list(theirs.columns)]
    key = lambda frame: sorted(frame.itertuples(index=False, name=None), key=repr)
    assert key(ours) == key(theirs) and len(ours)


# ---------------------------------------------------------------- decontamination


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered))


def plain_hits(text, items, width):
    words = [m.group() for m in plain_words(text)]
    hit, met = set(), set()
    for item, other in items:
        test = [m.group() for m in plain_words(other)]
        n = min(width, len(test))
        grams = {tuple(test[p : p + n]) for p in range(len(test) - n + 1)} if n else set()
        for p in range(len(words) - n + 1):
            if tuple(words[p : p + n]) in grams:
                hit.update(range(p, p + n))
                met.add(item)
    return len(words), hit, sorted(str(i) for i in met if i is not None)


def noise(rng, count, letters):
    return rng.choice([" ", ", ", "\n", "-"]).join(rng.choice(letters) for _ in range(count))


@pytest.mark.parametrize("block_words", [200_000, 60])
def test_hits_against_plain_search(spark, block_words):
    rng = random.Random(3)
    letters = ["a", "B", "é", "ÉA", "7", "x_y", "名前"]
    items = [(i % 23, noise(rng, rng.randint(0, 14), letters)) for i in range(30)]
    items += [(None, noise(rng, 6, letters)), (99, None), (98, "..."), (items[3][0] + 100, items[3][1])]
    docs = [(i % 70, noise(rng, rng.randint(0, 60), letters)) for i in range(80)]
    docs += [(500 + n, "zzz " + text.upper() + " ! " + text) for n, (_, text) in enumerate(items) if text]
    docs += [(None, "a b a"), (900, None), (901, ""), (902, "é" * 5000)]
    found = decontamination.hit_spans(
        documents(spark, *docs), spark.createDataFrame(items, "item_id int, text string"), width=6, block_words=block_words
    ).collect()
    ours = Counter(
        (r["doc_id"], r["n_words"], tuple(x for s in r["spans"] for x in range(s["begin"], s["end"])), tuple(r["items"])) for r in found
    )
    expected = Counter()
    for i, text in docs:
        n, hit, met = plain_hits(text, items, 6)
        expected[(i, n, tuple(sorted(hit)), tuple(met))] += 1
    assert ours == expected and sum(bool(k[2]) for k in ours) > 30


def test_long_items_are_cut_without_losing_windows(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 8)
    words = [f"w{i}" for i in range(57)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id int, text string")
    docs = documents(spark, *[(i, " ".join(words[i : i + 5])) for i in range(53)])
    found = decontamination.hit_spans(docs, items, width=5, block_words=20).collect()
    assert len(found) == 53 and all(r["items"] == ["1"] and r["spans"][0]["end"] == 5 for r in found)


def test_clean_texts_and_spans(spark):
    items = spark.createDataFrame([(7, "One two, THREE four")], "item_id long, text string")
    docs = documents(spark, (1, "é one-two three\nfour! five"), (2, "one two three fou"), (3, "x " * 9 + "one two three four"))
    rows = {r["doc_id"]: r for r in decontamination.decontaminate(docs, items).collect()}
    assert rows[1]["clean"] == "é ! five" and [tuple(s) for s in rows[1]["spans"]] == [(2, 20)] and rows[1]["dropped"]
    assert rows[2]["clean"] is None and not rows[2]["dropped"] and rows[2]["items"] == []
    assert rows[3]["n_hit"] == 4 and not rows[3]["dropped"] and rows[3]["clean"] == "x " * 9
    longer = decontamination.decontaminate(docs, items, longest=4).collect()
    assert all(r["clean"] is None for r in longer)


def test_without_items_or_documents(spark):
    none, docs = spark.createDataFrame([], "item_id long, text string"), documents(spark, (1, "a b"))
    assert [(r["n_words"], r["n_hit"]) for r in decontamination.decontaminate(docs, none).collect()] == [(2, 0)]
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontamination.decontaminate(docs.limit(0), items).collect() == []


def test_very_long_text_and_run(spark):
    item = " ".join(f"v{i}" for i in range(12))
    text = "ab" * 500_000 + " " + "v1 v2 " * 100_000 + item
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    row = decontamination.decontaminate(documents(spark, (1, text)), items).first()
    assert (row["n_words"], row["n_hit"]) == (200_013, 12)


def test_decontamination_against_sql(spark, sf_dir):
    against_sql(spark, sf_dir, "op11_decontamination", decontamination.op11_decontamination)


# ---------------------------------------------------------------- hard negatives


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label long, score string, rank string"
    return spark.createDataFrame([(*row, "extra", "extra") for row in rows], schema)


def plain_negatives(rows, is_anchor):
    good = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int), label))
    out = set()
    for a, v, label in good:
        if not is_anchor(a):
            continue
        scores = {(int(v @ w), i, other) for i, w, other in good if i != a and len(w) == len(v)}
        ranked = sorted(scores, key=lambda s: (-s[0], s[1]))
        for ps, p, _ in [s for s in ranked if s[2] == label][:5]:
            inside = [s for s in ranked if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps][:10]
            out |= {(a, p, n, i, ps, s) for n, (s, i, _) in enumerate(inside, 1)}
    return out


@pytest.mark.parametrize("size, components", [(24, 1_000_000), (3, 200), (1, 1_000_000)])
def test_negatives_against_all_pairs(spark, size, components):
    rng = np.random.default_rng(size)
    centres = rng.standard_normal((4, size))
    rows = [(i, (centres[i % 4] + rng.standard_normal(size) * (0.1 + i % 3)).tolist(), i % 4) for i in range(600)]
    rows += [(600 + i, [0.25] * size, i % 5) for i in range(60)]  # ties
    rows += [(700, [0.0] * size, 1), (703, None, 1), (706, [1.0] * size, None), (709, [float("nan")] * size, 1), (None, [1.0] * size, 1)]
    rows += [(712, [float("inf")] * size, 1), (715, [1.0] * (size + 1), 1), (718, [2.0] * (size + 1), 2), (721, [], 1), (724, [], 2)]
    rows += rows[:3]
    is_anchor = lambda i: i % 10 == 0
    df = vectors(spark, rows)
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, anchor_components=components).collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == plain_negatives(rows, is_anchor) and found


def test_bounds_hold_and_refining_settles_pairs():
    rng = np.random.default_rng(1)
    plain = np.floor(np.cumsum(rng.standard_normal((300, 30)), axis=1) * 256)  # neighbours are alike
    block = hard_negatives.Block(np.arange(300), np.zeros(300, int), plain, *hard_negatives.summaries(plain))
    exact, left = plain @ plain.T, []
    limit = np.quantile(exact, 0.95)

    def wanted(low, high, j):
        left.append(len(j))
        return high >= limit

    i, j, score = hard_negatives.open_pairs(block, block, np.ones((300, 300), bool), wanted)
    assert (score == exact[i, j]).all() and set(zip(*np.nonzero(exact >= limit))) <= set(zip(i, j))
    assert left[0] > left[1] > len(i)


def test_large_components_stay_exact(spark):
    rows = [(0, [40_000.25, 1.0], 1), (1, [40_000.5, 2.0], 1), (2, [20_000.0, 5.0], 2), (3, [1e30, 0.0], 2), (4, [3e38, 1.0], 1)]
    df = vectors(spark, rows)
    found = [tuple(r) for r in hard_negatives.hard_negatives(df, F.col("vec_id") == 0).collect()]
    assert found == [(0, 1, 1, 2, 10_240_064 * 10_240_128 + 256 * 512, 10_240_064 * 5_120_000 + 256 * 1280)]


def test_no_vectors_or_no_anchors(spark):
    df = vectors(spark, [(1, [1.0], 1)])
    for rows in (df.limit(0), df):
        assert hard_negatives.hard_negatives(rows, F.col("vec_id") == 2).collect() == []
    assert hard_negatives.hard_negatives(df, F.col("vec_id") == 1).collect() == []  # an anchor without positives


def test_negatives_against_sql(spark, sf_dir):
    against_sql(spark, sf_dir, "op12_hard_negatives", hard_negatives.op12_hard_negatives)


# ---------------------------------------------------------------- token alignment

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return token_alignment.ByteTokenizer(FIRST, public_tokenizers.PATTERN), token_alignment.PieceTokenizer(SECOND)


def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(FIRST)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = dict(zip(map(chr, plain), plain))
    for n, b in enumerate(b for b in range(256) if b not in plain):
        byte_of[chr(256 + n)] = b
    shown = []
    for text in texts:
        a, b = (one.encode(" " + text, add_special_tokens=False).ids, two.encode(text)) if text else ([], [])
        sides = [[bytes(byte_of[c] for c in one.id_to_token(i)) for i in a]]
        sides.append([bytes([int(two.id_to_piece(i)[1:-1], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b])
        if not text or any(b"".join(s) != b" " + text.encode() for s in sides):
            shown.append(None)
            continue
        ends = [[sum(map(len, s[: k + 1])) for k in range(len(s))] for s in sides]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            k, n = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append((a[i:k], b[j:n]))
            i, j = k, n
        shown.append((len(a), len(b), groups, Counter((x, y) for left, right in groups for x in left for y in right)))
    counts = Counter(pair for s in shown if s for pair in s[3])
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    rows = []
    for s in shown:
        if s is None:
            rows.append((0, 0, 0, 0, "", 0, 0))
            continue
        form = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in s[2])
        best = sum(n for (x, y), n in s[3].items() if counts[x, y] == most[x])
        total = sum(n * counts[pair] for pair, n in s[3].items())
        rows.append((s[0], s[1], len(s[2]), sum(s[3].values()), hashlib.sha256(form.encode()).hexdigest(), best, total))
    return rows


TEXTS = [
    None, "", " ", "the cat sat on the cat", "the cat sat on the cat", "  two  blanks\n\nand lines \t", "naïve 你好 😀 café",
    "a ▁ mark", "<s> </s> <|endoftext|> <0x41>", "a" * 300 + " " + "=" * 500, "it's 12,345.67 o'clock", "\x00\x1c\x85\xa0x", "ab\r\ncd",
]


def aligned(spark, texts, **more):
    df = documents(spark, *[(None if i == 4 else i // 2, text) for i, text in enumerate(texts)])
    make = lambda: token_alignment.Aligner(
        token_alignment.ByteTokenizer(FIRST, public_tokenizers.PATTERN), token_alignment.PieceTokenizer(SECOND)
    )
    return token_alignment.align_tokens(df, make, "tests", **more)


@pytest.mark.parametrize("broadcast_pairs", [2_000_000, 0])
def test_alignment_against_plain_search(spark, sf_dir, broadcast_pairs):
    sample = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 3000").limit(40).collect()]
    texts = TEXTS + sample
    rows = aligned(spark, texts, broadcast_pairs=broadcast_pairs)[0].collect()
    columns = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    expected = Counter(((None if i == 4 else i // 2), *row) for i, row in enumerate(plain_alignment(texts)))
    assert Counter((r["doc_id"], *[r[c] for c in columns]) for r in rows) == expected


def test_alignment_of_an_empty_table(spark):
    df = documents(spark, (1, "a")).limit(0)
    found = token_alignment.align_tokens(df, lambda: None)
    assert found[0].collect() == [] and found[1].collect() == []


def test_both_libraries_agree_on_the_first_tokenizer(both):
    first = both[0]
    points = [*range(0x3000), *range(0x3000, 0xD800, 13), *range(0xE000, 0x110000, 331)]
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}!{chr(c)} \n{chr(c)}{chr(c)}  " for c in points]
    assert [ids.tolist() for ids in first.encode(texts)] == [first._whole(" " + text) for text in texts]


def test_units_of_the_second_tokenizer_are_those_of_whole_texts(both, monkeypatch):
    rng = random.Random(5)
    letters = ["a", "the", " ", "  ", "\n", "\t", " \n", "\x1c", "\x85", "\xa0", "\u2003", "é", "你", "😀", "▁", "<s>", "<0x41>", "1", "'s", "=", "\x00", "\u200b", "ﬁ", "\r\n"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    whole = both[1]._model.encode(texts, num_threads=1)
    monkeypatch.setattr(token_alignment, "_CACHED_UNITS", 500)
    found = [ids.tolist() for at in range(0, len(texts), 100) for ids in both[1].encode(texts[at : at + 100])]
    assert found == whole


def test_very_long_texts(both, monkeypatch):
    aligner = token_alignment.Aligner(*both)
    blanks, letters, words = " " * 1_000_000, "ab" * 150_000, "the cat " * 40_000
    found = list(aligner.documents([blanks, letters, words, "你" * 100_000]))
    assert all(f[0] and f[2] for f in found)
    assert found[2][0] == len(both[0]._whole(" " + words)) and not any(len(key) > 1000 for key in aligner._windows)


def test_sides_that_spell_other_bytes_have_no_tokens(both):
    """As a tokenizer that changes what it is given would."""
    aligner = token_alignment.Aligner(*both)
    shouting = lambda texts: [ids[::-1] for ids in both[0].encode(texts)]
    aligner._first = type("Other", (), {"encode": staticmethod(shouting)})
    found = [f[:5] for f in aligner.documents(["the cat sat", "cat"])]
    assert found[0] == (0, 0, 0, 0, "") and found[1][0]


def test_forgotten_windows_change_nothing(both, monkeypatch):
    texts = [t for t in TEXTS if t] * 3
    kept = [f[:5] for f in token_alignment.Aligner(*both).documents(texts)]
    monkeypatch.setattr(token_alignment, "_CACHED_WINDOWS", 2)
    small = token_alignment.Aligner(*both)
    assert [f[:5] for text in texts for f in small.documents([text])] == kept


def test_units_are_those_of_the_pattern():
    """Texts without odd white space are split the plain way, with the same units."""
    rng = random.Random(5)
    parts = ["a", "bc", "é", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "."]
    texts = ["".join(rng.choices(parts, weights=[9, 9, 9, 12, *[1] * 10], k=rng.randint(0, 14))) for _ in range(5000)]
    plain = 0
    for text in ["", " ", " a", "a ", "a \xa0b", "\u3000 a", *texts]:
        units = token_alignment._units(text)
        assert [u for u in units if u] == [u[1:] for u in token_alignment._UNIT.split(" " + text) if u[1:]]
        plain += units == text.split(" ")
    assert plain > 500


def test_a_text_is_aligned_once_for_each_new_window(both):
    """A window met before is looked up by its number, not aligned again, and its counts add up."""
    aligner = token_alignment.Aligner(*both)
    once, *_ = aligner.documents(["one two three four"])
    known = len(aligner._forms)
    again, twice = aligner.documents(["one two three four", "one two three four one two three four"])
    assert again[:5] == once[:5] and len(aligner._forms) - known <= 1
    assert twice[0] == 2 * once[0] and twice[6].sum() == twice[3]


def one_by_one(both, texts):
    """What is said of texts by plain search, without the counts of the corpus."""
    return [row[:5] for row in plain_alignment(texts)]


def test_units_are_encoded_once_by_either_tokenizer(both):
    """A text of units met before costs neither tokenizer anything."""
    given = Counter()

    def counting(side, name):
        def encode(texts):
            given[name] += sum(map(len, texts))
            return getattr(side, name)(texts)

        return encode

    aligner = token_alignment.Aligner(*both)
    aligner._first = type("First", (), {"encode": staticmethod(counting(both[0], "encode"))})
    list(aligner.documents(["one two, three\nfour five"] * 3))
    before = Counter(given)
    again = list(aligner.documents(["five two, one", "one two, three\nfour " * 50 + "one"]))
    assert before["encode"] < 40 and given == before
    assert [f[:5] for f in again] == one_by_one(both, ["five two, one", "one two, three\nfour " * 50 + "one"])


def test_units_of_both_tokenizers_on_random_texts(both, monkeypatch):
    rng = random.Random(8)
    parts = ["a", "the", "Anti", "é", "你好", "😀", " ", " ", " ", "  ", "\n", "\t", " \n", "\r\n", "\x1c", "\x85", "\xa0", "\u2003", "▁", "'s", "'", "12", ".", "=" * 30, "\x00", "\u200b", "<s>", "ﬁ"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(1500)]
    monkeypatch.setattr(token_alignment, "_LONG_UNIT", 12)
    monkeypatch.setattr(token_alignment, "_CACHED_WINDOWS", 400)
    aligner = token_alignment.Aligner(*both)
    found = [f for at in range(0, len(texts), 50) for f in aligner.documents(texts[at : at + 50])]
    assert [f[:5] for f in found] == one_by_one(both, texts)
    assert all(int(f[6].sum()) == f[3] and (np.diff(f[5]) > 0).all() for f in found)


def test_an_odd_unit_sets_its_texts_apart_alone(both):
    """As where a tokenizer changes one letter: its unit has no tokens, its neighbours in a line do."""
    aligner = token_alignment.Aligner(*both)
    changing = lambda texts: both[0].encode([text.replace("q", "k") for text in texts])
    aligner._first = type("Other", (), {"encode": staticmethod(changing)})
    texts = ["the cat sat", "the qat", "a mat sat", "qat"]
    found = [f[:5] for f in aligner.documents(texts)]
    plain = one_by_one(both, texts)
    assert found == [plain[0], (0, 0, 0, 0, ""), plain[2], (0, 0, 0, 0, "")]
    assert [f[:5] for f in aligner.documents(["sat the mat"])] == one_by_one(both, ["sat the mat"])


def test_forms_of_ids_with_any_number_of_digits():
    rows = token_alignment.digits(10_101)
    assert [bytes(row[row != 0]) for row in rows] == [str(i).encode() for i in range(10_101)]
