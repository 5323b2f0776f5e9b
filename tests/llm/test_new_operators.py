"""Cross-tokenizer alignment, packing and periodic runs against brute force, and their edge cases; rules on the source."""

import hashlib
import pathlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from churnspark.llm import alignment, language, packing, periodic_runs, quality, tokenizing, words
from churnspark.llm.queries import LLM_ORACLE, LLM_QUERIES
from churnspark.llm.substring_dedup import substring_dedup

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SOURCES = sorted((pathlib.Path(__file__).parents[2] / "churnspark/llm").glob("*.py"))

DOCS = "doc_id long, text string, id string, runs string, length string, pairs string, sequence_id string"
ODD = [
    (1, None), (2, ""), (3, " "), (4, "  a"), (5, "a "), (6, "<|endoftext|> </s><s>"), (7, "▁x"), (8, "漢字 é😀\n\n\tx  y"), (9, "\x00"), (9, "dup"),
    (None, "dup"), (None, "dup"), (10, "=" * 5000), (11, "ﬁ"), (12, "word " * 3000), (13, "😀" * 200), (14, "\r\n \x85 "), (15, "a b " * 30_000),
]


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", "z", "u", "v") for i, t in rows], DOCS)


# 11 Cross-tokenizer alignment


def brute_alignment(texts):
    from tokenizers import Tokenizer

    a_side, b_side = Tokenizer.from_file(BYTE), tokenizing.piece_tokenizer(PIECE).model
    a_side.encode_special_tokens = True
    a_bytes = tokenizing.byte_tokenizer(BYTE, True).entry_bytes()
    b_bytes = lambda i: bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode()
    found, documents = [], Counter()
    for text in texts:
        groups = []
        if text:
            a, b, raw = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text), (" " + text).encode()
            if b"".join(a_bytes[i] for i in a) == raw == b"".join(map(b_bytes, b)):
                left, right, x, y = [], [], 0, 0
                a, b = list(a), list(b)
                while a or b:
                    if x <= y and a and not (x == y and left):
                        left.append(a.pop(0))
                        x += len(a_bytes[left[-1]])
                    else:
                        right.append(b.pop(0))
                        y += len(b_bytes(right[-1]))
                    if x == y and left and right:
                        groups.append((left, right))
                        left, right = [], []
        links = Counter((p, q) for g in groups for p in g[0] for q in g[1])
        documents.update(set(links))
        found.append((groups, links))
    best = {}
    for (p, _), n in documents.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for groups, links in found:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(n for k, n in links.items() if documents[k] == best[k[0]]), sum(n * documents[k] for k, n in links.items()),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        ))
    return out


def mixed_texts():
    rng = random.Random(4)
    parts = ["the", " ", "  ", "\n", "é", "漢", "'s", "12", ".", "internationalisation", "zzgh", "Straße", "x" * 450, "</s>", "–", "coração", "año"]
    return [(100 + i, " ".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))) for i in range(60)]


@pytest.mark.parametrize("hot", [1, 1 << 16])
def test_alignment(spark, monkeypatch, hot):
    """With a hot part of 1 no pair but the only one is hot, so all counts go to the blocks."""
    monkeypatch.setattr(alignment, "HOT", hot)
    rows = [r for r in ODD if r[0] != 15] + mixed_texts()
    got = [tuple(r) for r in alignment.align_tokenizers(frame(spark, rows).repartition(5), BYTE, PIECE).collect()]
    want = [(i, *w) for (i, _), w in zip(rows, brute_alignment([t for _, t in rows]))]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_alignment_shows_groups_and_large_ones(spark, monkeypatch):
    monkeypatch.setattr(alignment, "EXPANDED", 3)  # links made a few at a time
    rows = [(1, "Straße 漢字"), (2, "zzgh " * 40)]
    got = alignment.align_tokenizers(frame(spark, rows), BYTE, PIECE, digest=False).collect()
    want = [w for w in brute_alignment([t for _, t in rows])]
    assert [hashlib.sha256(r.groups.encode()).hexdigest() for r in sorted(got)] == [w[-1] for w in want]
    assert [tuple(r)[1:7] for r in sorted(got)] == [w[:6] for w in want]


def test_alignment_of_nothing(spark):
    assert alignment.align_tokenizers(frame(spark, []), BYTE, PIECE).count() == 0
    (only,) = alignment.align_tokenizers(frame(spark, [(None, None)]), BYTE, PIECE).collect()
    assert tuple(only) == (None, 0, 0, 0, 0, 0, 0, "")


def test_memories_forget_the_older_generation():
    calls = []
    memory = tokenizing.Memory(lambda k: calls.append(k) or k.upper(), most=3)
    for key in "abcabcdaeafag":
        assert memory[key] == key.upper()
    assert calls.count("a") == 1 and len(memory) <= 3 and len(memory.older) <= 3
    v = alignment.Vocabularies(BYTE, PIECE)
    texts = [t for _, t in mixed_texts()]
    first = v.encode(texts)
    v.older, v.known = v.known, {}
    assert v.encode(texts) == first


def test_tokenizers_in_pieces():
    from tokenizers import Tokenizer

    whole, piece = Tokenizer.from_file(BYTE), tokenizing.piece_tokenizer(PIECE)
    texts = [t or "" for _, t in ODD[:17]] + [t for _, t in mixed_texts()]
    for text in texts:
        assert np.frombuffer(tokenizing.byte_tokenizer(BYTE).encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(piece.encode(text), "<u4").tolist() == piece.model.encode(text)


def test_texts_encoded_together():
    from tokenizers import Tokenizer

    whole, rng = Tokenizer.from_file(BYTE), random.Random(5)
    signs = [chr(c) for c in range(0x260)] + [" ", "\n", "'"] * 20 + ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "漢", "\u3000", "<|endoftext|>"]
    texts = [t or "" for _, t in ODD[:17]] + [t for _, t in mixed_texts()]
    texts += ["".join(rng.choices(signs if i % 2 else " \n\t'sdtlrevm.,#9aé", k=rng.randrange(14))) for i in range(4000)]
    for plain in (False, True):
        whole.encode_special_tokens = plain
        ids, sizes = tokenizing.byte_tokenizer(BYTE, plain).encode_all([t.encode() for t in texts])
        ends = np.cumsum(sizes)
        for text, a, b in zip(texts, ends - sizes, ends, strict=True):
            assert ids[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids, text
    assert [x.tolist() for x in tokenizing.byte_tokenizer(BYTE).encode_all([])] == [[], []]


def test_stretches_are_encoded_once(monkeypatch):
    tokenizer = tokenizing.ByteTokenizer(BYTE)
    calls = []
    monkeypatch.setattr(tokenizer, "merge", lambda word, right=tokenizer.merge: calls.append(word) or right(word))
    ids, sizes = tokenizer.encode_all([b"one### two### one\ntwo ### one"] * 500)
    assert len(sizes) == 500 and sorted(calls) == ["###", "one", "two", "\u010a"]


# 12 Best-fit packing


def check_packing(rows, got, capacity, end_id):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BYTE)
    texts = Counter((i, t or "") for i, t in rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for i in {i for i, _ in rows}:
        want = Counter()
        for (_, text), n in ((k, n) for k, n in texts.items() if k[0] == i):
            ids = np.array([*whole.encode(text, add_special_tokens=False).ids, end_id], "<u4")
            cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                want[k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += n
        assert want == Counter((r.piece, r.start, r.length, r.ids_crc32) for r in by_id[i])
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = LLM_QUERIES["op12_pack_documents"](spark, sf).collect()
    n = check_packing(rows, got, 2048, 0)
    total = sum(r.length for r in got)
    assert n <= -(-total // 2048) + 1


def test_packing_edges(spark):
    got = packing.pack_documents(frame(spark, ODD).repartition(3), BYTE, 64, 2, with_ids=True)
    n = check_packing(ODD, got.collect(), 64, 2)
    filled = packing.packed_sequences(got).collect()
    assert len(filled) == n and all(len(r.ids) <= 64 for r in filled)
    assert sum(len(r.ids) for r in filled) == sum(r.length for r in got.collect())
    assert packing.pack_documents(frame(spark, []), BYTE).count() == 0


def test_knapsack_and_fillings():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths = np.unique(rng.integers(2, 12, 4))
        worth = np.full(31, -np.inf)
        worth[lengths] = rng.random(len(lengths))
        best, take = packing.knapsack(worth, 30)
        plain = np.zeros(31)
        for room in range(1, 31):
            plain[room] = max([plain[room - 1], *(worth[n] + plain[room - n] for n in lengths if n <= room)])
        assert best == pytest.approx(plain)
        rows = packing.fillings(lengths, take, 30)
        for k, n in enumerate(lengths):
            mine = rows[rows[:, 0] == k]
            assert (mine[:, 1] * mine[:, 2]).sum() <= 30 and n in mine[:, 1]
            assert (worth[mine[:, 1]] * mine[:, 2]).sum() == pytest.approx(worth[n] + best[30 - n])


@pytest.mark.parametrize("seed", range(4))
def test_plans_are_whole_and_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    count = np.zeros(513, np.int64)
    np.add.at(count, [rng.integers(1, 513, 3000), rng.integers(150, 250, 3000), np.full(2000, 512), rng.integers(1, 9, 3000)][seed], rng.integers(1, 40))
    plan = packing.plan_packing(count, 512)
    length = np.repeat(np.arange(513), count)
    rank = np.concatenate([np.arange(n) for n in count])
    sequence, offset = plan.place(length, rank)
    order = np.lexsort((offset, sequence))
    s, o, n = sequence[order], offset[order], length[order]
    new = np.append(True, s[1:] != s[:-1])
    assert (o[new] == 0).all() and (o[1:][~new[1:]] == (o + n)[:-1][~new[1:]]).all() and (o + n).max() <= 512
    assert len(np.unique(s)) == plan.sequences and plan.bound <= plan.sequences
    fitted = sum(g.copies for g in packing.best_fit([], count.copy(), 512))  # without the linear program
    assert plan.sequences <= 1.02 * fitted


def test_few_large_counts_make_few_rows():
    """The plan's size follows the lengths, not the pieces."""
    count = np.zeros(2049, np.int64)
    count[[1, 700, 1300, 2048]] = [10**12, 3 * 10**9, 10**9, 10**11]
    plan = packing.plan_packing(count, 2048)
    assert len(plan.key) < 100 and plan.bound <= plan.sequences <= plan.bound * 1.01


# 13 Periodic run detection


def brute_runs(w, least):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def run_texts():
    rng = random.Random(2)
    texts = []
    for _ in range(250):
        n, kinds = rng.choice([0, 1, 5, 13, 40, 150]), rng.choice([1, 2, 3, 60])
        t = [b"%d" % rng.randrange(kinds) for _ in range(n)]
        if n > 5 and rng.random() < 0.6:
            p, s = rng.randint(1, n // 3), rng.randrange(n)
            t = [t[i] if i < s else t[s + (i - s) % p] for i in range(n)]
        texts.append(t)
    morse, fib, flip = [b"a"], [[b"a"], [b"a", b"b"]], {b"a": b"b", b"b": b"a"}
    for _ in range(11):
        morse = morse + [flip[c] for c in morse]
        fib.append(fib[-1] + fib[-2])
    return [*texts, morse, fib[-1], [b"a"] * 500, [b"a", b"b"] * 300 + [b"c"] + [b"b", b"a"] * 300]


@pytest.mark.parametrize("least", [2, 3, 12])
def test_runs_of_words(least):
    texts = run_texts()
    numbered, first = periodic_runs.numbered(texts)
    low, high, period = periodic_runs.runs_of(numbered, first, least)
    got = [[] for _ in texts]
    for s, e, q, d in zip(low, high, period, np.searchsorted(first, low, "right") - 1):
        got[d].append((int(s - first[d]), int(e - s), int(q)))
    assert got == [brute_runs(t, least) for t in texts]


def test_grammar_derives_the_text():
    """Every node's halves are nodes or words that meet in its middle, and equal names derive equal words."""
    numbered, first = periodic_runs.numbered(run_texts()[:60])
    nodes = periodic_runs.grammar(numbered, first)
    by_name = {}
    for a, _, b, name in zip(*nodes):
        assert by_name.setdefault(name, numbered[a:b].tolist()) == numbered[a:b].tolist() and (numbered[a:b] >= 0).all()
    assert (nodes.start < nodes.middle).all() and (nodes.middle < nodes.end).all()


def test_hash_that_lies_is_found_out(monkeypatch):
    """Stretches whose hashes agree though their words do not are refused, and other hashes are taken."""
    equal = periodic_runs.Stretches.equal
    made = []

    class Lying(periodic_runs.Stretches):
        def __init__(self, numbered, seed):
            made.append(seed)
            self.lies = seed == 1
            super().__init__(numbered, seed)

        def equal(self, one, two, n):
            return np.ones(len(one), bool) if self.lies else equal(self, one, two, n)

    monkeypatch.setattr(periodic_runs, "Stretches", Lying)
    numbered, first = periodic_runs.numbered([[b"a", b"b", b"c"] * 9 + [b"x", b"y"]])
    assert [c.tolist() for c in periodic_runs.runs_of(numbered, first, 12)] == [[1], [28], [3]] and made == [1, 2]


def test_periodic_runs(spark):
    rows = [*ODD, (20, "x " + "a b c " * 9 + "d"), (21, "a b c " * 3 + "a b"), (22, "a b c " * 4 + "q")]
    got = periodic_runs.periodic_runs(frame(spark, rows).repartition(4)).collect()
    want = []
    for i, text in rows:
        w = (text or "").encode().split()
        runs = brute_runs(w, 12) if len(w) < 10_000 else [(0, len(w), 2)]
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((i, len(w), runs, b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    assert sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got], key=str) == sorted(want, key=str)
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0


def test_periodic_query_on_odd_ids(spark, tmp_path):
    """Planted periods by the rule, for negative ids and texts of blanks."""
    rows = [(i, f"w{i} " * (i % 3) + " ".join(f"t{k % (abs(i) % 11 + 2)}" for k in range(abs(i) % 70))) for i in range(-300, 300)]
    rows += [(10_000 + i, " \t") for i in range(60)] + [(20_000 + i, None) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    got = LLM_QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    want = con.sql(LLM_ORACLE["op13_periodic_runs"])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want.select(", ".join(columns)).fetchall(), key=str)


# Words, draws and rules


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_different_long_words_are_different(spark):
    """A pattern and its complement, whose polynomials modulo 2^64 are equal in every base."""
    one = thue_morse(1024)
    two = one.translate(str.maketrans("ab", "ba"))
    for family in (0, 1):
        h = words.word_hashes(words.split_words([f"{one} {two} {one}".encode()]), family)
        assert h[0] == h[2] != h[1]
    long = words.word_hashes(words.split_words([b"12345678 1234567812345678 123456781234567 1"]))
    assert len(set(long.tolist())) == 4
    rest = " ".join(f"w{i}" for i in range(19))
    got = {r.doc_id: r.n_removed for r in substring_dedup(frame(spark, [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{one} {rest}")])).collect()}
    assert got == {1: 0, 2: 0, 3: 20}


def test_sums_in_the_prime_field():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, words.MODULUS, 500, dtype=np.uint64) for _ in range(2))
    edge = np.array([0, 1, words.MODULUS - 1], np.uint64)
    a, b = np.concatenate([a, edge, edge]), np.concatenate([b, edge[::-1], edge])
    assert words.prime_product(a, b).tolist() == [int(x) * int(y) % words.MODULUS for x, y in zip(a, b)]
    assert words.prime_powers(12345, 40).tolist() == [pow(12345, k, words.MODULUS) for k in range(41)]
    assert words.prime_sums(a).tolist() == [sum(int(x) for x in a[:k]) % words.MODULUS for k in range(len(a) + 1)]


def test_copies_and_frequent_labels_do_not_crowd_out_the_rest(spark):
    """A text on a third of the rows counts once, and a rare label is drawn whole."""
    rows = [("copied text here", "en")] * 1000 + [(f"text number {i}", "en") for i in range(2000)] + [("rare words only", "xx"), (None, "yy"), ("t", None)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    from churnspark.llm.labelled import draw_labelled

    drawn = draw_labelled(docs, "lang", 50).collect()
    assert Counter(r.label for r in drawn) == {"en": 50, "xx": 1}
    assert len({r.text for r in drawn}) == 51 and {r.label: r.of for r in drawn} == {"en": 2001, "xx": 1}
    assert sorted(drawn) == sorted(draw_labelled(docs.repartition(2), "lang", 50).collect())


def test_language_score_by_hand(spark):
    """The score of a text against a plain computation from counted words."""
    docs = [("ein haus und ein hund", "de"), ("a house and a dog", "en"), ("la casa y el perro", "es")]
    model = language.fit_language_model(spark.createDataFrame(docs, "text string, lang string"))
    n = {lang: Counter(text.split()) for text, lang in docs}
    known = len(set().union(*n.values()))
    asked = "und haus dog"
    logs = np.array([np.mean([np.log((n[lang][w] + 0.5) / (sum(n[lang].values()) + 0.5 * known)) for w in asked.split()]) for lang in sorted(n)])
    chance = np.exp(logs * 3 - (logs * 3).max())
    got = language.predict_language(spark.createDataFrame([(asked,)], "text string"), model).first()
    assert got.lang_pred == sorted(n)[int(chance.argmax())] and got.score == pytest.approx(chance.max() / chance.sum(), abs=1e-5)


def test_language_model_with_limits(spark):
    docs = spark.createDataFrame([("aa aa bb cc", "x"), ("dd dd dd ee", "y")], "text string, lang string")
    model = language.fit_language_model(docs, most_words=1, most_grams=2)
    assert set(model.tables[0]) == {"aa", "dd"} and all(len(t) <= 4 for t in model.tables[1:])


def test_vote_of_all_neighbours(spark):
    """Scores equal a plain loop over all labelled vectors; copies of a labelled text vote once."""
    rng = random.Random(3)
    rows = [(" ".join(rng.choice(["good", "fine", "nice", "well"] if i % 3 else ["bad!", "poor!", "junk!"]) for _ in range(8)), int(i % 3 > 0)) for i in range(120)]
    rows += [rows[0]] * 60
    model = quality.fit_quality_model(spark.createDataFrame(rows, "text string, quality int"), each=30)
    assert len(model.labels) <= 60 and len(model.labels) == len(np.unique(model.vectors.round(5), axis=0)) or len(set(rows)) >= len(model.labels)
    texts = [b"good junk! fine", b"poor! poor! bad!", b"nice", b""]
    scores = quality.vote(model, texts)
    latent = quality.unit((quality.features(texts) * model.rarity) @ model.space)
    for score, v in zip(scores, latent):
        cosines = np.array([float(v @ u) for u in model.vectors])
        near = sorted(range(len(cosines)), key=lambda i: -cosines[i])[: quality.NEIGHBOURS]
        weight = [max(cosines[i], 0) ** quality.SHARPNESS * model.weights[i] for i in near]
        want = sum(w * model.labels[i] for w, i in zip(weight, near)) / sum(weight) if sum(weight) else model.base
        assert score == pytest.approx(want, abs=0.02)


@pytest.mark.parametrize("pattern", [r"\.localCheckpoint\(", r"\.crossJoin\(", r"\.rdd\b", r"F\.udf\(", r"\.collect\(\)\s*\n?\s*for "])
def test_not_used(pattern):
    assert [p.name for p in SOURCES if re.search(pattern, p.read_text())] == []


def test_broadcast_hints_are_bounded():
    """A plain broadcast hint stands only where a parameter, a count or a measured size bounds the rows."""
    plain = {p.name: len(re.findall(r"F\.broadcast\(", p.read_text())) for p in SOURCES}
    assert {k: v for k, v in plain.items() if v} == {"alignment.py": 1, "decontaminate.py": 2, "ngram_join.py": 1, "sharding.py": 2}
