"""Language, near-duplicates, personal data, piece coding and token files."""

import random
import re
import time
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from tallycast.llm import language_id, near_dedup, personal_data, piece_coding, token_files

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, ids string, kept boolean"


def documents(spark, *rows):
    """``(doc_id, text)`` rows with the other columns and clashing ones."""
    full = [(i, text, "en", "s", len(text or ""), "extra", None) for i, text in rows]
    return spark.createDataFrame(full, DOCUMENT)


# ---------------------------------------------------------------- language


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language_id.op2_language_id(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(found) == docs.count() and found.score.between(0, 1).all()
    assert (found.held_out == found.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    held_out = found[found.held_out]
    assert (held_out.lang == held_out.lang_pred).mean() > 0.97


def test_language_learns_only_from_its_part(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1)
    free = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    docs = documents(spark, (held, "xyzzy xyzzy xyzzy"), (free[0], "hello there world"), (free[1], "hello world again"))
    known = language_id.learn(docs.filter(~language_id.held_out("doc_id")))
    assert known.containing(language_id.trigrams(["xyzzy"])[1]).sum() == 0


def test_small_languages_are_learned_and_take_nothing(spark, monkeypatch):
    hot = "the quick brown fox jumps over the lazy dog and runs away from here " * 400
    rows = [("en", hot)] * 20 + [("tiny", "zalu mipo kerav"), ("noise", "the")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    known = language_id.learn(docs)
    assert known.languages == ["en", "tiny", "noise"]
    assert known.predict(["kerav zalu", "the dog jumps over the fox", "the the"])[0] == ["tiny", "en", "en"]
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="3 languages"):
        language_id.learn(docs)


def test_language_edges(spark):
    docs = documents(spark, (1, None), (2, ""), (3, "123 ..."), (None, "hello world"), (4, "hello world"), (4, "hello world"))
    known = language_id.learn(docs)
    found = language_id.predict_languages(docs, known).collect()
    assert Counter((r["doc_id"], r["lang_pred"]) for r in found) == {(1, "und"): 1, (2, "und"): 1, (3, "und"): 1, (None, "en"): 1, (4, "en"): 2}
    nothing = language_id.learn(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.predict_languages(docs, nothing).collect()} == {"und"}
    assert language_id.predict_languages(docs.limit(0), known).count() == 0


def test_trigrams_against_plain_python():
    texts = ["Ab, cd1é", "", "a", "--x y--", "İi ß"]
    owner, grams, has = language_id.trigrams(texts)
    for k, text in enumerate(texts):
        plain = "".join(c if c.isalpha() else " " for c in text.lower())
        spaced = " " + " ".join(plain.split()) + " "
        expected = Counter(spaced[i : i + 3] for i in range(len(spaced) - 2) if spaced[i + 1] != " ")
        shown = Counter("".join(chr((int(g) >> s) & 0x1FFFFF) for s in (42, 21, 0)) for g in grams[owner == k])
        assert shown == expected and has[k] == bool(plain.strip())


def test_bloom_slices_have_no_false_negatives_and_known_false_positives():
    rng = np.random.default_rng(0)
    members = [rng.integers(0, 2**60, n).astype(np.uint64) for n in (900, 400, *[50] * 70)]
    known = language_id.LanguageFilter.build([f"l{k}" for k in range(72)], members)
    for k in (0, 1, 71):
        assert (known.containing(members[k])[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).all()
    others = rng.integers(0, 2**60, 50_000).astype(np.uint64)
    hits = (known.containing(others)[:, 0] & np.uint64(1)).mean()
    assert hits == pytest.approx(known.false_positive_rates()[0], rel=0.3, abs=1e-4)


# ---------------------------------------------------------------- near-duplicates


def weighted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def plain_jaccard(a, b):
    every = set(a) | set(b)
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in every) for d in set(a) & set(b))


def test_probability_jaccard_against_its_formula():
    rng = np.random.default_rng(3)
    for _ in range(30):
        words = [[f"w{k}" for k in rng.integers(0, 9, rng.integers(0, 40))] for _ in range(2)]
        texts = [" ".join(w) for w in words]
        bags = [near_dedup.shingles([t])[1:] for t in texts]
        assert near_dedup.probability_jaccard(*bags) == pytest.approx(plain_jaccard(*map(weighted, texts)))


def test_prob_min_hash_estimates_it():
    rng = np.random.default_rng(1)
    a = dict(zip(range(0, 200), rng.integers(1, 9, 200)))
    b = dict(zip(range(60, 260), rng.integers(1, 9, 200)))
    value = near_dedup._mixed(np.array([*a, *b], np.uint64))
    weight = np.array([*a.values(), *b.values()], float)
    owner = np.repeat([0, 1], 200)
    signed = near_dedup.prob_min_hash(owner, value, weight, 2, 20_000)
    assert (signed[0] == signed[1]).mean() == pytest.approx(plain_jaccard(Counter(a), Counter(b)), abs=0.02)
    alone = near_dedup.prob_min_hash(owner[200:] - 1, value[200:], weight[200:], 1, 20_000)
    assert (alone[0] == signed[1]).all()  # a set's registers do not depend on what it is signed with


def copies(rng):
    """Chains and stars of near copies, an oversized group and texts that share a passage."""
    word = lambda: f"w{rng.integers(0, 5000)}"
    texts = []
    for _ in range(6):  # a chain: each step changes a few words more
        words = [word() for _ in range(150)]
        for _ in range(6):
            texts.append(" ".join(words))
            words = list(words)
            words[rng.integers(0, 150)] = word()
            words[rng.integers(0, 150)] = word()
    base = [word() for _ in range(120)]
    for _ in range(150):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 4)):
            words[at] = word()
        texts.append(" ".join(words))
    passage = [word() for _ in range(60)]
    texts += [" ".join([*[word() for _ in range(40)], *passage]) for _ in range(60)]
    return texts + texts[:40] + texts[:1] * 50


def test_near_duplicates_against_all_pairs(spark):
    texts = copies(np.random.default_rng(7))
    order = np.random.default_rng(8).permutation(len(texts))
    texts = [texts[i] for i in order]
    different = {}
    for i, text in enumerate(texts):
        different.setdefault(text, i)
    root = {i: i for i in different.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    bags = {i: weighted(text) for text, i in different.items()}
    for (i, a), (j, b) in combinations(bags.items(), 2):
        if len(set(a) & set(b)) > 30 and plain_jaccard(a, b) >= 0.8:
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    expected = {i: (different[text], find(different[text])) for i, text in enumerate(texts)}
    found = near_dedup.near_duplicates(documents(spark, *enumerate(texts))).collect()
    assert {r["doc_id"]: (r["class_id"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_inside_a_family_below_the_limit(spark, count=300):
    rng = np.random.default_rng(11)
    fresh = iter(range(10**9))
    own = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    passage = own(400)
    texts = [" ".join([*passage, *own(int(rng.integers(54, 59)))]) for _ in range(count)]
    for _ in range(20):  # planted pairs share a few words more
        more = own(int(rng.integers(8, 12)))
        texts += [" ".join([*passage, *more, *own(56 - len(more))]) for _ in range(2)]
    texts = [texts[i] for i in rng.permutation(len(texts))]
    bags = [set(weighted(t)) for t in texts]
    likeness = {(i, j): len(a & b) / len(a | b) for (i, a), (j, b) in combinations(enumerate(bags), 2)}
    linked = {pair for pair, x in likeness.items() if x >= 0.8}
    assert len(linked) == 20 and all(0.8 <= likeness[p] <= 0.825 for p in linked)
    assert all(0.76 < x < 0.795 for p, x in likeness.items() if p not in linked)
    expected = {i: i for i in range(len(texts))} | {b: a for a, b in linked}
    found = near_dedup.near_duplicates(documents(spark, *enumerate(texts))).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected


def test_block_links_against_all_pairs(monkeypatch):
    monkeypatch.setattr(near_dedup, "_COLUMNS", 64)
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 40, 80)]
    texts = []
    for _ in range(40):
        words = list(base)
        for at in rng.integers(0, 80, rng.integers(0, 5)):
            words[at] = f"w{rng.integers(0, 60)}"
        texts.append(" ".join(words))
    for cut in (40, 17):
        pairs = combinations(range(40), 2) if cut == 40 else ((i, j) for i in range(17) for j in range(17, 40))
        every = {p for p in pairs if plain_jaccard(weighted(texts[p[0]]), weighted(texts[p[1]])) >= 0.8}
        found = near_dedup.block_links(texts, np.arange(40), cut, 0.8)
        assert {(i, j) for i, j, _ in found} <= every and every
        ends = lambda links: components_of(links, 40)
        assert ends((i, j) for i, j, _ in found) == ends(every)


def components_of(links, count):
    root = list(range(count))
    for a, b in links:
        x, y = root[a], root[b]
        root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def test_blocks_of_large_components_and_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    test_near_duplicates_against_all_pairs(spark)
    test_near_duplicates_inside_a_family_below_the_limit(spark, 60)


def test_near_duplicate_edges(spark):
    rows = [(1, None), (2, None), (3, ""), (4, " \n"), (5, "a b c"), (6, "a b c"), (6, "a b c"), (None, "a b c"), (8, "q " * 3000), (9, "q " * 3001)]
    docs = documents(spark, *rows)
    found = sorted(((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs).collect()))
    assert found == [(0, None, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (6, 5, False), (6, 5, False), (8, 8, True), (9, 8, False)]
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0
    stage = near_dedup.near_dedup_stage(spark, docs.unionAll(docs), "")
    assert sorted((r["doc_id"] or 0) for r in stage.collect()) == [0, 0, 1, 2, 3, 4, 5, 8]
    assert stage.columns == ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("shift", [0, 2**63 - 10])
def test_near_duplicates_where_an_id_has_several_texts(spark, shift):
    words = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    a, b, c, d = map(words, "abcd")
    rows = [(1, a), (1, b), (2, b + " x"), (3, a), (4, c), (4, c + " x"), (5, c + " x"), (7, d), (7, d), (6, d + " x"), (6, None)]
    docs = documents(spark, *((i + shift, text) for i, text in rows))
    found = near_dedup.near_duplicates(docs).collect()
    ids = sorted((r["doc_id"] - shift, r["class_id"] - shift, r["component_id"] - shift) for r in found)
    assert ids == [(1, 1, 1), (1, 1, 1), (2, 2, 1), (3, 1, 1), (4, 4, 4), (4, 4, 4), (5, 4, 4), (6, 6, 6), (6, 6, 6), (7, 7, 6), (7, 7, 6)]
    assert sorted(r["doc_id"] - shift for r in found if r["kept"]) == [1, 1, 4, 6, 6]
    stage = [(r["doc_id"] - shift, r["text"]) for r in near_dedup.near_dedup_stage(spark, docs, "").collect()]
    assert len(stage) == 5 and {(1, a), (1, b), (6, None), (6, d + " x")} < set(stage)
    assert len({(4, c), (4, c + " x")} & set(stage)) == 1


def test_near_duplicate_groups_are_dealt_by_no_hot_key(spark):
    docs = documents(spark, *enumerate(copies(np.random.default_rng(5))))
    plan = near_dedup._groups(spark.range(9).selectExpr("id % 3 as key", "id as v", "id as root"))
    shuffles = re.findall(r"hashpartitioning\(whole#\d+L?, [^)]*\)", plan._jdf.queryExecution().executedPlan().toString())
    assert len(shuffles) == 2  # of the two sums alone, which combine ahead of them
    assert near_dedup.near_duplicates(docs).count() == docs.count()
    work = Path(near_dedup.work_path(spark, "x")).parent
    assert not list(work.glob("near-texts-*"))


# ---------------------------------------------------------------- personal data


def plain_spans(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m[0])
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0:
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


PERSONAL = [
    (1, None), (2, ""), (3, "é😀 a.b+c@x-y.co.uk, 1.2.3.4 256.1.1.1 0255.0.0.1 1.2.3.4.5"), (4, "4111 1111 1111 1111 4111111111111112 4111-1111-1111-1111"),
    (5, "+1 (555) 123-4567 +12 +1234567890123456 +44.20.7946.0958"), (None, "mail a@b.c"), (None, "mail a@b.c"), (6, "x" * 50_000 + " 9" * 20_000),
    (7, "٣.٣.٣.٣ a@b"),
]


def test_personal_data_against_plain_search(spark):
    found = personal_data.find_personal_data(documents(spark, *PERSONAL)).collect()
    expected = Counter((i, tuple(plain_spans(text))) for i, text in PERSONAL)
    assert Counter((r["doc_id"], tuple(map(tuple, r["base"]))) for r in found) == expected
    assert personal_data.find_personal_data(documents(spark, *PERSONAL).limit(0)).count() == 0


def test_base_spans_of_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in personal_data.op7_personal_data(spark, sf_dir).collect()}
    for row in rows:
        spans = plain_spans(row["text"])
        assert [found[row["doc_id"]][f"n_{k}"] for k in personal_data.KINDS[:4]] == [sum(s[0] == k for s in spans) for k in range(4)]


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    seeds = [(i, f"so please write to me at user{i}@mail{i}.example.com before noon") for i in range(6)]
    unseen = [(10, "so please write to me at user_at_mail_7788 before noon"), (11, "the badge user_at_mail_7789 is here")]
    found = {r["doc_id"]: r["spans"] for r in personal_data.find_personal_data(documents(spark, *seeds, *unseen)).collect()}
    assert [tuple(s) for s in found[10]] == [(4, 25, 42)] and found[11] == []


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(11)
    letters = ["a", "b.c", "@", "@", ".", "1", "22", "333", " ", "+", "-", "(", "é", "٣", "@x.y", "1.2.3.4", ".5", "%", "_"]
    for _ in range(60_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        assert personal_data.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["1" * 1_000_000, "a" * 1_000_000 + " x@y", "a@" * 500_000, "1." * 500_000, "1.2.3.4," * 100_000, "+1(" * 300_000])
def test_long_runs_take_linear_time(text):
    begun = time.process_time()
    base, hits = personal_data.scan(text)
    assert time.process_time() - begun < 10
    assert len(base) == {"1.1.1.1.": 125_000, "1.2.3.4,": 100_000}.get(text[:8], 0)


def test_only_a_pattern_of_the_second_round_finds_the_identifier(spark):
    """Seeds make one pattern; what it accepts, three times, makes another that holds no seed."""
    texts = [f"please write to user{i}@mail{i}.example.com today" for i in range(9)]
    texts += [f"please write to badge_{i}_77 today" for i in (501, 502, 503)]
    texts += [f"our contact number badge_{i}_77 stands" for i in (501, 502, 503)]
    texts += ["our contact number ident_9090_77 stands", "some other number ident_8080_77 sits"]
    rows = personal_data.find_personal_data(documents(spark, *enumerate(texts))).collect()
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in rows}
    assert all(found[i] == [4] for i in range(9, 16)) and found[16] == []


def plain_patterns(texts):
    """The whole of the bootstrapping with dictionaries."""
    edges = {}
    for text in set(texts):
        for _, _, value, seed, around in personal_data.scan(text)[1]:
            for pattern in around:
                edges[pattern, value] = edges.get((pattern, value), False) or seed
    for turn in range(personal_data.ROUNDS):
        if turn:
            accepted = {v for p, v in edges if p in good}
            edges = {(p, v): seed or v in accepted for (p, v), seed in edges.items()}
        values, seeds = Counter(p for p, _ in edges), Counter(p for (p, _), seed in edges.items() if seed)
        own = {p: seeds[p] / values[p] for p in values if seeds[p] >= personal_data.MIN_SEEDS}
        left = {}
        for (p, v), seed in edges.items():
            if not seed and p in own:
                left[v] = left.get(v, 1) * (1 - min(own[p], 0.999))
        gain = Counter()
        for (p, v), seed in edges.items():
            if not seed and p in own:
                gain[p] += 1 - left[v]
        good = {p for p in own if (seeds[p] + gain[p] * own[p]) / values[p] >= personal_data.CONFIDENCE}
    return good


def test_context_spans_against_dictionaries(spark):
    rng = random.Random(5)
    words = ["write", "to", "badge", "number", "is", "call", "x" * 70, "id:"]
    things = [f"u{i}@m.example.com" for i in range(6)] + [f"ident_{i}_{i * 77 + 1000}" for i in range(12)] + ["10.0.0.1", "word"]
    texts = [" ".join(rng.choice(words) if rng.random() < 0.7 else rng.choice(things) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    good = plain_patterns(texts)
    expected = []
    for text in texts:
        _, hits = personal_data.scan(text)
        expected.append(sorted({(4, s, e) for s, e, _, seed, around in hits if not seed and good.intersection(around)}))
    rows = personal_data.find_personal_data(documents(spark, *enumerate(texts))).collect()
    found = {r["doc_id"]: [tuple(s) for s in r["spans"] if s["kind"] == 4] for r in rows}
    assert [found[i] for i in range(len(texts))] == expected and any(expected)


def test_redaction(spark):
    docs = documents(spark, *PERSONAL)
    stage = {r["doc_id"]: r for r in personal_data.personal_data_stage(spark, docs, "").collect()}
    assert stage[3]["text"] == "é😀 <EMAIL>, <IP> 256.1.1.1 <IP> <IP>.5" and stage[3]["n_chars"] == len(stage[3]["text"])
    assert stage[1]["text"] is None and stage[2]["text"] == "" and stage[None]["text"] == "mail <EMAIL>"
    assert len(personal_data.personal_data_stage(spark, docs, "").collect()) == len(PERSONAL)


# ---------------------------------------------------------------- pieces


def as_unigram():
    """The library with the same pieces and scores, told to take the best path.

    Blank runs score -1e9 in the file, at which the library's single precision loses what
    tells other paths apart; here they are merely worse than all other pieces.
    """
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40_000.0)
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_best_paths_equal_the_library(spark, sf_dir):
    library = as_unigram()
    coder = piece_coding.PieceCoder(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    lines = [line for text in texts for line in text.split("\n")][:1500]
    for line in lines:
        assert coder.encode(line).tolist() == library.encode(line)


def test_best_path_against_all_paths():
    coder = piece_coding.PieceCoder(public_tokenizers.path("piece_bpe_32k.model"))
    library = as_unigram()
    scores = {library.id_to_piece(i): library.get_score(i) for i in range(259, library.get_piece_size())}

    def best(text):
        found = [0.0]
        for end in range(1, len(text) + 1):
            found.append(max([found[k] + scores[text[k:end]] for k in range(max(0, end - 16), end) if text[k:end] in scores], default=-np.inf))
        return found[-1]

    for text in ("▁hello▁world", "▁internationalization", "éèê▁ñandú", "▁Straße,▁12.5%"):
        path = [library.id_to_piece(i) for i in coder.best_path(text)]
        assert "".join(path) == text and sum(scores[p] for p in path) == best(text)


def test_piece_round_trip(spark):
    texts = ["", " ", "  two  blanks ", "line\nbreak\r\n\ttab", "😀 é ß 中文 \x00  ", "a" * 5000, "▁", None]
    docs = documents(spark, *enumerate(texts))
    found = {r["doc_id"]: r for r in piece_coding.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert [found[i]["round_trip"] for i in range(8)] == [True] * 6 + [False, True]
    assert found[7]["ids"] == [] and all(len(r["ids"]) == r["n_tokens"] for r in found.values())
    assert piece_coding.encode_pieces(docs.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_all_documents_round_trip(spark, sf_dir):
    found = piece_coding.op8_piece_coding(spark, sf_dir)
    assert found.filter("not round_trip").count() == 0
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


# ---------------------------------------------------------------- token files


HARD = [
    "Don't stop...,.", "áb ́c ,.x e.,e ١٢٣,. 12.5,", "x<|endoftext|>. <|startoftext|>, <|ENDOFTEXT|>", "İstanbul. ΣΑΣ. \x1cfoo\x1d,bar  b c.퟿",
    "it's. 's. s's", "你好。 ,你 好.", "ÉCOLE, été.\r\n\x0b..", "l',", "é'.", "'.", "a'll.,'s", "KELVIN ſ", "!!, !!. a!,", "",
]


def reference_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_word_encoder_equals_the_library():
    encoder = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), cached_words=3)
    for text in HARD:
        assert encoder.encode([text])[0].tolist() == reference_ids(text)


def test_word_encoder_leaves_composing_to_the_library():
    marked = ["H\u0331", "J\u030c", "T\u0308", "Y\u030a", "W\u030a", "A\u030a.", "\u00c9TAT, Stop.", "\u0331 \u212b"]
    texts = [*marked, " ".join(marked), f"Plain Words. {marked[0]}ara, END. \x80 \ufffd", "\u00dcber <|Endoftext|> Y\u030a. ABC."]
    encoder = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for text, ids in zip(texts, encoder.encode(texts)):
        assert list(ids) == reference_ids(text), text


def test_word_encoder_equals_the_library_on_random_texts():
    rng = random.Random(9)
    letters = ["H", "a", "é", "ß", "İ", "ÀB", "ª", "²", "½", "\u0331", "\u030a", "ˆ", "»", ".", ",", "..", " ", "\n", "\t", "\u00a0", "'s", "1", "名", "<|endoftext|>", "\x80", "ǅ"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(30_000)]
    encoder = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    found = [ids.tolist() for at in range(0, len(texts), 500) for ids in encoder.encode(texts[at : at + 500])]
    assert [t for t, a, b in zip(texts, found, expected) if a != b] == []
    below = [f"x{chr(c)}. {chr(c)}Y,{chr(c)} B{chr(c)}" for c in range(1, 0x300)]
    expected = [e.ids for e in library.encode_batch(below, add_special_tokens=False)]
    assert [t for t, a, b in zip(below, encoder.encode(below), expected) if a.tolist() != b] == []


def test_word_encoder_looks_each_different_word_up_once():
    """However often the words of the texts given at once come again, and whatever stands between them."""

    class Counting(dict):
        asked = 0

        def get(self, *key):
            Counting.asked += 1
            return super().get(*key)

    encoder = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["the cat,, sat.\n", "", " \t", "\x0bcat\x0cthe. ", "na\u00efve cat"] * 200
    encoder.encode(["one word"])
    encoder._cached = Counting(encoder._cached)
    found = encoder.encode(texts)
    assert Counting.asked <= 20
    assert [ids.tolist() for ids in found[:5]] == [reference_ids(text) for text in texts[:5]]
    assert all((ids == found[n % 5]).all() for n, ids in enumerate(found))


def test_stops_are_set_apart_after_letters_alone():
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choices(["a", "\u00e9", "1", "!", ".", ",", " ", "\n", "\t"], k=rng.randint(0, 9)))
        # stops after a letter, to the end of the text or up to a blank or a new line
        apart = re.sub(r"(?<=[a\u00e9])[.,]+(?=[ \n]|$)", lambda found: " " + found[0], text)
        assert token_files.WordEncoder._spaced(text).decode() == apart


@pytest.mark.parametrize("ids", [[], [0] * 9, [2**32 - 1], [255, 1], [256], list(range(0, 70_000 * 61_000, 61_000))])
def test_bit_planes_round_trip(ids):
    block = np.array(ids, "<u4")
    assert (token_files.from_planes(len(block), token_files.planes(block)) == block).all()


def test_reader_fetches_any_range(tmp_path):
    path = tmp_path / "x.tbp"
    ids = np.random.default_rng(0).integers(0, 50_000, 5000).astype("<u4")
    ids[1000:2000] = 0
    with open(path, "wb") as out:
        writer = token_files.BitPlaneWriter(out, block_ids=512)
        for begin in range(0, 5000, 777):
            writer.add(begin, ids[begin : begin + 777])
        assert writer.close() == 5000
    with open(path, "rb") as source:
        reader = token_files.BitPlaneReader(source, path.stat().st_size)
        for begin, end in ((0, 5000), (511, 513), (1100, 1200), (4999, 5000), (7, 7)):
            assert (reader.ids(begin, end) == ids[begin:end]).all()
        assert reader.doc_ids.tolist() == list(range(0, 5000, 777)) and reader.counts.sum() == 5000


def test_token_files_against_the_library(spark, tmp_path):
    rows = [*enumerate(HARD), (-5, None), (3, "again"), (None, "no id")]
    docs = documents(spark, *rows)
    files = token_files.write_token_files(docs, str(tmp_path / "out"), public_tokenizers.path("word_bpe_49k.json"))
    found = token_files.document_digests(files, str(tmp_path / "out")).orderBy("start").collect()
    expected, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*reference_ids(text), token_files.END_ID], "<u4")
        expected.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert [tuple(r) for r in found] == expected
    none = token_files.write_token_files(docs.limit(0), str(tmp_path / "none"), public_tokenizers.path("word_bpe_49k.json"))
    assert token_files.document_digests(none, str(tmp_path / "none")).count() == 0
