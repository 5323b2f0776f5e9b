"""The training-data operators against brute force, and their edge cases: nulls, empties, repeats, clashing names."""

import hashlib
import random
import sys
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from churnspark.llm import chunks, language, mixing, quality, range_coder, sharding, words
from churnspark.llm.chat import escape, escape_role, read_conversations, render_conversations, unescape, unescape_role
from churnspark.llm.decontaminate import decontaminate
from churnspark.llm.embedding_links import embedding_links
from churnspark.llm.ngram_join import in_order, linked, needed, ngram_join, pack, unpack
from churnspark.llm.queries import LLM_ORACLE, LLM_QUERIES
from churnspark.llm.substring_dedup import COVERS, substring_dedup
from churnspark.llm.token_files import PieceTokenizer, read_token_frames, write_token_frames

TABLES = ["documents", "benchmark", "conversations", "embeddings", "labels"]
DOCS = "doc_id long, text string, lang string, source string, chunk string, id string, score string, size string"


def docs_frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, src, "x", "y", "z", "w") for i, t, lang, src in rows], DOCS)


def odd_rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = text(60), text(200).split()
    rows = [(None, "a null id", "en", None), (1, None, "en", "s"), (2, "", None, "s"), (3, " \t\n", "en", "t"), (4, "...", "en", "t")]
    rows += [(5, "one", "en", "s"), (6, "one", "en", "s"), (6, "one", "en", "s"), (7, "word " * 3000, "en", "s"), (8, text(20_000), "en", "t")]
    rows += [(10 + k, text(30) + " " + passage + "\n" + text(10), "en", "u") for k in range(6)]
    for k in range(25):  # near copies: single words changed
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
        rows.append((100 + k, " ".join(copy), "en", "s"))
    rows += [(200 + k, " ".join(base), "fr", "v") for k in range(5)]
    return rows


def without_ids(rows):
    return [r for r in rows if r[0] is not None and r != (6, "one", "en", "s")] + [(6, "one", "en", "s")]


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as from '{sf}/{t}.parquet'")
    got = LLM_QUERIES[name](spark, sf).toPandas()
    want = con.sql(LLM_ORACLE[name]).df()
    assert sorted(got) == sorted(want)
    as_rows = lambda df: sorted(map(tuple, df[sorted(df)].astype(str).values))
    assert as_rows(got) == as_rows(want)


def test_registered():
    assert len([q for q in LLM_QUERIES if q.startswith("op")]) == 13


# Words and hashes


def test_covers():
    for period, cover in COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_words_and_windows():
    texts = [b"a  b\tc", None, b"", b"\n", b"x" * 600_000 + b" y", b"b c a b"]
    w = words.split_words(texts)
    assert np.diff(w.first).tolist() == [3, 0, 0, 0, 2, 4]
    h = words.word_hashes(w)
    assert h[1] == h[5] and h[0] == h[7] and h[3] != h[0]
    full = words.whole_windows(w, 2)
    found = words.window_hashes(h, 2)[full]
    assert len(full) == 2 + 1 + 3 and found[0] == found[5] and found[1] == found[3]


# 1 Substring dedup


def brute_dedup(rows, window):
    seen, out = set(), {}
    for i, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0], r[1] or "")):
        ws = (text or "").encode().split()
        gone = set()
        for k in range(len(ws) - window + 1):
            key = tuple(ws[k : k + window])
            if key in seen:
                gone.update(range(k, k + window))
            seen.add(key)
        out[i] = (len(ws), len(gone), b" ".join(w for k, w in enumerate(ws) if k not in gone).decode())
    return out


@pytest.mark.parametrize("window", [1, 4, 20])
def test_substring_dedup(spark, window):
    rows = without_ids(odd_rows())
    got = substring_dedup(docs_frame(spark, rows), window=window).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute_dedup(rows, window) and len(got) == len(rows)


def test_substring_dedup_repeats_and_null_ids(spark):
    text = " ".join(f"v{i}" for i in range(25))
    got = substring_dedup(docs_frame(spark, [(9, text, "", ""), (9, text, "", ""), (None, text, "", "")])).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 25), (False, 25), (True, 0)]


# 2 Language


def test_language(spark, sf):
    got = LLM_QUERIES["op2_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    train = docs_frame(spark, [(1, "the cat and the dog", "en", ""), (2, "der hund und die katze", "de", ""), (3, "ignored", None, ""), (4, None, "en", "")])
    model = language.fit_language_model(train)
    asked = docs_frame(spark, [(1, None, "", ""), (2, "123 ... ²", "", ""), (3, "the thedog", "", ""), (4, "KATZE hundkatze", "", ""), (5, "", "", ""), (6, "漢字", "", "")])
    rows = {r.doc_id: r for r in language.predict_language(asked, model).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3, 4, 5)] == ["und", "und", "en", "de", "und"]
    assert rows[6].score == 0.5 and rows[3].chunk == "x" and 0.5 < rows[3].score <= 1 and rows[1].score == 0
    none = language.fit_language_model(train.limit(0))
    assert {r.lang_pred for r in language.predict_language(asked, none).collect()} == {"und"}


def test_language_backs_off_by_length():
    model = language.LanguageModel(["a", "b"], [{"xy": 0}, {"x": 1}, {"xy": 2}, {"^xy": 3}, {}, {}], np.zeros((4, 2), np.float32))
    assert [language.evidence_rows(model, w) for w in ("xy", "xyz", "zxyz", "zxz", "zz")] == [[0], [3], [2], [1], []]


# 3 N-gram join

ngram_join_module = sys.modules["churnspark.llm.ngram_join"]


def brute_components(rows, width, percent):
    sets = {}
    for i, text, *_ in rows:
        ws = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        sets[i] = {tuple(ws[k : k + width]) for k in range(max(len(ws) - width + 1, 1))} if ws else set()
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (1, 60)])
def test_ngram_join(spark, width, percent):
    rng = random.Random(percent)
    rows = without_ids(odd_rows()) + [(300 + k, " ".join(rng.choice("abcde") for _ in range(rng.randrange(1, 12))), "", "") for k in range(60)]
    base = [f"q{i}" for i in range(150)]
    for k in range(120):  # a cluster around the threshold, larger than a visited component
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(150)] = f"m{rng.randrange(10**6)}"
        rows.append((1000 + k, " ".join(copy), "", ""))
    got = ngram_join(docs_frame(spark, rows), width=width, percent=percent).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute_components(rows, width, percent) and len(got) == len(rows)


def test_ngram_join_visits_by_groups(spark, monkeypatch):
    """A document visits a large component once, in groups of its members, not once for each chunk that holds some."""
    monkeypatch.setattr(ngram_join_module, "BIG", 8)
    monkeypatch.setattr(ngram_join_module, "TILE", 4)
    monkeypatch.setattr(ngram_join_module, "ROUNDS", 1)
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 600)
    written, right = {}, ngram_join_module.staged
    monkeypatch.setattr(ngram_join_module, "staged", lambda df, name="stage": written.setdefault(name, []).append(right(df, name)) or written[name][-1])
    rng = random.Random(4)
    rows, heart = [], [f"h{i}" for i in range(30)]
    for k in range(40):  # a large component
        rows.append((k, " ".join([*heart, *(f"t{rng.randrange(3)}" for _ in range(6))]), "", ""))
    for k in range(30):  # documents with half of its text
        rows.append((100 + k, " ".join([*heart[: rng.randrange(16, 28)], *(f"u{rng.randrange(400)}" for _ in range(rng.randrange(3, 14)))]), "", ""))
    got = ngram_join(docs_frame(spark, rows), width=2, percent=60).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute_components(rows, 2, 60)
    visits = written["visits"][0]
    assert 0 < visits.count() == visits.select("id", "component").distinct().count()


def test_packed_counts():
    counts = np.array([0, 1, 255, 256, 1 << 40, 0], np.int64)
    assert unpack(pack(counts)).tolist() == counts.tolist()


def test_prefix_tree_stops():
    sets = [np.arange(k, k + 20, dtype=np.uint64) for k in (0, 40, 1, 2)]
    assert linked(sets, sets[0], 60, in_order(sets), 1) == [0] and linked(sets, sets[0], 60) == [0, 2, 3]


def test_prefix_tree():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 90, rng.integers(1, 80)).astype(np.uint64)) for _ in range(200)]
    for query in sets[:20]:
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, query)) >= 60 * len(np.union1d(s, query))]
        assert sorted(linked(sets, query, 60)) == want
    assert needed(100, 100, 85) == 92 and linked([], sets[0], 85) == []


def test_ngram_join_repeats_and_null_ids(spark):
    rows = [(None, "a b c d e", "", ""), (7, "a b c d e", "", ""), (7, "a b c d e", "", ""), (9, "A b C d e", "", "")]
    got = sorted((tuple(r) for r in ngram_join(docs_frame(spark, rows)).collect()), key=str)
    assert got == [(7, 2, 7), (7, 2, 7), (9, 2, 7), (None, 2, 7)]


def test_ngram_join_texts_that_share_an_id(spark):
    """Unrelated texts under one id do not join the documents near them."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(7, a, "", ""), (7, b, "", ""), (8, a + " end", "", ""), (9, b + " end", "", "")]
    rows += [(None, a + " null", "", ""), (None, "alone by itself here", "", ""), (None, None, "", ""), (10, None, "", "")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(docs_frame(spark, rows)).collect()), key=str)
    assert got == sorted([(7, 57, 7), (7, 57, 7), (8, 58, 7), (9, 58, 7), (None, 58, 7), (None, 1, None), (None, 0, None), (10, 0, 10)], key=str)
    far = [(1, a, "", ""), (5, b, "", ""), (5, a + " end", "", ""), (6, b + " end", "", "")]
    assert {r.component_id for r in ngram_join(docs_frame(spark, far)).where("doc_id = 6").collect()} == {5}
    assert sorted(r.component_id for r in ngram_join(docs_frame(spark, far)).where("doc_id = 5").collect()) == [1, 5]


# 4 Chat


def test_chat_escapes():
    for text in ["", "\\", "\\n", "<s>", "<\\s>", "</s>[INST] ok [/INST]", "<|im_end|>\n", "<<|im_end|>", "a\\\\<|im_start|>\\"]:
        assert unescape(escape(text)) == text and unescape_role(escape_role(text + "\n")) == text + "\n"
        assert "<|im_end|>" not in escape(text) and "\n" not in escape_role(text + "\n")


def test_chat_folds_events(spark):
    log = [
        (1, 0, 0, "message", "user", "Hi"), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", None, "wro"),
        (1, 1, 3, "delta", None, "ng"), (1, 1, 4, "regenerate", None, None), (1, 1, 5, "delta", None, "right </s>"),
        (1, 0, 6, "edit", None, "Hello"), (1, 2, 7, "message", "user", "gone"), (1, 2, 8, "delete", None, None),
        (1, 3, 9, "delta", "assistant", "é"), (None, None, 0, "message", None, None), (1, 0, 0, "message", "user", "Hi"),
    ]
    events = spark.createDataFrame([(*e, "extra") for e in log], "conv_id long, turn long, seq long, kind string, role string, text string, part string")
    rendered = render_conversations(events)
    got = {r.conv_id: r for r in read_conversations(rendered).collect()}
    turns = "user\nHi\nuser\nHello\nassistant\nright </s>\nassistant\né\n"
    assert got[1].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest() and got[1].n_turns == 4
    assert got[1].loss_sha256 == hashlib.sha256("right </s>é".encode()).hexdigest() and got[1].loss_chars == 11
    assert got[None].n_turns == 1 and got[None].loss_chars == 0
    assert read_conversations(render_conversations(events.limit(0))).count() == 0


# 5 Mixing


def test_targets_fill_up(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 1), (None, 0)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got["b"] == 30 and got["c"] == 3 and got[None] == 0 and got["a"] == 1011 - 33


def test_mixing_edges(spark):
    rows = odd_rows()
    frame = docs_frame(spark, rows)
    got = mixing.mix_sources(frame).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r.size for r in got)
    taken, target, most = {}, {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source], most[r.source] = r.target, max(most.get(r.source, 0), r.size)
    assert all(abs(taken[s] - target[s]) <= most[s] for s in taken)
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(mixing.mix_sources(frame.repartition(7)).collect(), key=key)
    assert mixing.mix_sources(frame.limit(0)).count() == 0


def test_mixing_cuts_equal_rows_one_by_one(spark):
    rows = [(None, "x x x x", "", "a")] * 30 + [(i, "y y y y", "", "b") for i in range(30)]
    taken, target = {}, {}
    for r in mixing.mix_sources(docs_frame(spark, rows)).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert target == {"a": 80, "b": 160} and all(abs(taken[s] - target[s]) <= 2 for s in target)


# 6 Token files


@pytest.mark.parametrize("n", [0, 1, 17, 2047, 2048, 2049, 6000])
def test_range_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), np.full(n, 50256), rng.zipf(1.5, n) % 50257):
        frame = range_coder.encode_frame(np.array([3]), np.array([n]), ids.astype(np.int32))
        names, lengths, back = range_coder.decode_frame(frame)
        assert back.tolist() == ids.tolist() and names.tolist() == [3] and lengths.tolist() == [n]


@pytest.mark.parametrize("most", [65535, 65536, 100_277, 1 << 20, (1 << 31) - 1])
def test_range_coder_large_ids(most):
    rng = np.random.default_rng(most)
    for ids in (rng.integers(0, most, 5000), np.full(2049, most), rng.zipf(1.3, 5000) % most):
        ids[-1] = most
        frame = range_coder.encode_frame(np.array([3]), np.array([len(ids)]), ids.astype(np.int32))
        assert range_coder.decode_frame(frame)[2].tolist() == ids.tolist()
    for wrong in (-1, 1 << 31):
        with pytest.raises(ValueError, match="token ids"):
            range_coder.encode_frame(np.array([3]), np.array([1]), np.array([wrong]))


def test_range_coder_checks_ids(monkeypatch):
    ids = np.arange(3000, dtype=np.int32)
    frame = range_coder.encode_frame(np.array([3]), np.array([3000]), ids)
    right = range_coder.run
    monkeypatch.setattr(range_coder, "run", lambda *a: right(*a) ^ 1)
    with pytest.raises(ValueError, match="damaged"):
        range_coder.decode_frame(frame)


def test_range_coder_learns_and_checks():
    ids = np.tile(np.arange(50, dtype=np.int32) * 999, 200)
    frame = range_coder.encode_frame(np.array([1]), np.array([len(ids)]), ids)
    assert len(frame) < len(ids) * 2 / 4
    for at in (10, len(frame) - 3):
        with pytest.raises(ValueError, match="damaged"):
            range_coder.decode_frame(frame[:at] + bytes([frame[at] ^ 1]) + frame[at + 1 :])


def test_range_coder_halves(monkeypatch):
    monkeypatch.setattr(range_coder, "HALVES", 100)
    rng = np.random.default_rng(5)
    for ids in (rng.integers(0, 1 << 31, 3000), rng.integers(0, 99, 3000), np.arange(101) + 100):
        frame = range_coder.encode_frame(np.array([3]), np.array([len(ids)]), ids)
        assert range_coder.decode_frame(frame)[2].tolist() == ids.tolist()


@pytest.mark.parametrize("distinct", [2, 700, 50_000])
def test_range_coder_order_zero(distinct):
    """Without any order in them, ids take little more than their entropy (the low bytes were coded uniformly before)."""
    rng = np.random.default_rng(distinct)
    chance = 1 / np.arange(1, distinct + 1)
    chance /= chance.sum()
    ids = rng.choice(distinct, 400_000, p=chance)
    frame = range_coder.encode_frame(np.array([3]), np.array([len(ids)]), ids)
    assert range_coder.decode_frame(frame)[2].tolist() == ids.tolist()
    assert len(frame) < len(ids) * (-(chance * np.log2(chance)).sum() / 8 + 0.05) + 4 * distinct


def test_range_coder_blocks_alone():
    """With the model of the frame any block can be decoded by itself."""
    ids = np.random.default_rng(6).zipf(1.4, 5 * range_coder.BLOCK_IDS) % 5000
    model, symbols = range_coder.Model.learn(np.ascontiguousarray(ids.reshape(5, -1).T))
    model, blocks = range_coder.Model.unpacked(model.packed()), range_coder.write(model, symbols)
    for k, block in enumerate(blocks):
        alone = range_coder.run(model, [block], range_coder.BLOCK_IDS)
        assert alone[:, 0].tolist() == ids.reshape(5, -1)[k].tolist()


@pytest.mark.parametrize("order", [1, 2])
def test_range_coder_mixes_all_followers(order):
    """Several equally frequent ids follow each context; one guess a context took more than the entropy by 2 bits an id."""
    rng, ids = np.random.default_rng(order), [0, 1]
    for draw in rng.integers(0, 4, 200_000).tolist():
        ids.append((ids[-1] * 5 + draw * 16) % 64 if order == 1 else (ids[-2] * 5 + ids[-1] * 3 + draw * 4) % 16)
    ids = np.array(ids, np.int32)
    frame = range_coder.encode_frame(np.array([3]), np.array([len(ids)]), ids)
    assert range_coder.decode_frame(frame)[2].tolist() == ids.tolist()
    assert len(frame) * 8 / len(ids) < 2.35


def test_range_coder_adds_up_the_orders():
    """Every id's span is the sum of its shares under orders 2, 1 and 0, and the spans of a context fill it."""
    rng, ids = np.random.default_rng(9), [0, 1]
    for draw in rng.integers(0, 8, 512 * 200).tolist():
        ids.append((ids[-1] * 7 + draw + (ids[-2] * 3 if draw < 4 else 0)) % 40)
    model, _ = range_coder.Model.learn(np.array(ids[2:]).reshape(-1, 512).T.copy())
    one, two, n = model.one, model.two, len(model.ids)
    assert np.bincount(one.context).max() > 2 and np.bincount(two.context).max() > 2
    for pair in np.unique(two.context):
        last, x = one.symbol[pair - 1], np.arange(n)
        start, size = model.span(np.full(n, pair), np.full(n, last), x, *one.places(range_coder.keyed(np.full(n, last), x, n, n)))
        assert start[0] == 0 and start[-1] + size[-1] == range_coder.ONE and (start[1:] == (start + size)[:-1]).all() and size.min() >= 1
        part = [np.bincount(o.symbol[rows], o.count[rows], n) / o.count[rows].sum() if rows.any() else np.zeros(n)
                for o, rows in ((one, one.context == last), (two, two.context == pair))]
        share1, share2 = one.share[last] / 256, two.share[pair] / 256
        want = share2 * part[1] + (1 - share2) * (share1 * part[0] + (1 - share1) * model.frequency / model.frequency.sum())
        assert np.abs(size / range_coder.ONE - want).max() < 1e-6


def test_token_files(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    plain = tokenizers.Tokenizer.from_file(path)
    texts = ["a   b", " x", "x  \nfoo \n bar ", "  ", "a <|endoftext|> b", "x\t y\n\n z ", "é漢字 ñ", "a ", "b  c", "I'll  go "]
    assert PieceTokenizer(path).encode(texts) == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 7] + [(900 + i, t, "", "") for i, t in enumerate(texts)]
    got = sorted(read_token_frames(write_token_frames(docs_frame(spark, rows), path)).collect(), key=lambda r: r.start)
    start = 0
    for r, (i, text, *_) in zip(got, sorted(rows, key=lambda r: (r[0], r[1] or "")), strict=True):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        assert tuple(r) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


# 7 Decontamination


def test_decontaminate_edges(spark):
    items = [(1, "Alpha, beta gamma"), (2, None), (3, "..."), (4, " ".join(f"k{i}" for i in range(14))), (4, "zeta"), (None, "omega")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, window string")
    rows = [(1, "x ALPHA beta; gamma zeta y", "", ""), (1, "other", "", ""), (2, " ".join(f"K{i}" for i in range(2, 13)), "", ""), (3, None, "", ""),
            (4, "", "", ""), (5, "alpha beta", "", ""), (None, "zeta zeta", "", ""), (2, " ".join(f"K{i}" for i in range(2, 13)), "", "")]
    got = sorted((tuple(r) for r in decontaminate(docs_frame(spark, rows), bench).collect()), key=str)
    assert got == sorted(
        [(1, 6, 4, 2, "1,4", True), (1, 1, 0, 0, "", False), (2, 11, 11, 1, "4", True), (2, 11, 11, 1, "4", True), (3, 0, 0, 0, "", False),
         (4, 0, 0, 0, "", False), (5, 2, 0, 0, "", False), (None, 2, 2, 1, "4", True)], key=str)
    assert decontaminate(docs_frame(spark, []), bench).count() == 0
    assert {r.contaminated for r in decontaminate(docs_frame(spark, rows), bench.limit(0)).collect()} == {False}


def test_decontaminate_without_broadcast(spark, monkeypatch):
    from churnspark.llm import decontaminate as module

    bench = spark.createDataFrame([(k, f"u{k} v w") for k in range(20)], "item_id long, text string")
    docs = docs_frame(spark, [(k, f"a u{k} v w b u{k + 1} v", "", "") for k in range(25)])
    small = sorted(decontaminate(docs, bench).collect())
    monkeypatch.setattr(module, "BROADCAST_BYTES", -1)
    assert sorted(decontaminate(docs, bench).collect()) == small and sum(r.n_hit for r in small) == 60


# 8 Embeddings


def test_embedding_links(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 32))
    rows = [(i, (centres[i % 30] + 0.15 * rng.standard_normal(32)).tolist()) for i in range(300)]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, (np.array(rows[4][1]) * 1e30).tolist())]
    wanted = np.array([v for _, v in rows])
    unit = wanted / np.linalg.norm(wanted, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    odd = [(600, None), (601, []), (602, [0.0] * 32), (603, [float("nan")] * 32), (604, [None] * 32), (605, [1.0, float("inf")]), (606, [1.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<double>, rep int")
    got = {r.vec_id: r for r in embedding_links(frame).collect()}
    assert len(got) == len(rows) + len(odd)
    found, true = sum(got[i].n_links for i, _ in rows), near.sum() - len(rows)
    assert 0.95 * true <= found <= true
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in odd)
    assert got[500].component_id == got[3].component_id == got[501].component_id and got[502].component_id == got[4].component_id
    assert embedding_links(frame.limit(0)).count() == 0


def test_embedding_blocks(spark, monkeypatch):
    from churnspark.llm import embedding_links as module

    monkeypatch.setattr(module, "BLOCK", 8)
    rng = np.random.default_rng(4)
    rows = [(i, (np.ones(16) + 0.02 * rng.standard_normal(16)).tolist()) for i in range(70)]
    got = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(69, 0)}


# 9 Sharding


def test_differencing_is_tight():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 10_000) for _ in range(2000)]
    found = sharding.differencing(sizes, 24)
    sums = [sum(s for s, f in zip(sizes, found, strict=True) if f == k) for k in range(24)]
    assert max(sums) - min(sums) <= 50 and sharding.differencing([], 3) == [] and sharding.differencing([5], 3) == [0]


def test_sharding(spark):
    rows = odd_rows()
    got = sharding.shard_documents(docs_frame(spark, rows), shards=5).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"}
    slots, shard_of = {}, {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert shard_of.setdefault(r.text_crc32, r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(r.size for r in got) == sum(len((t or "").encode()) + 8 for _, t, *_ in rows)
    assert sharding.shard_documents(docs_frame(spark, [])).count() == 0


# 10 Quality


def test_quality(spark, sf):
    got = LLM_QUERIES["op10_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.9 * len(got)


def test_quality_edges(spark):
    model = quality.fit_quality_model(spark.createDataFrame([("good words here", 1), ("bad! bad! bad!", 0), (None, 1), ("x", None)], "text string, quality int"))
    asked = docs_frame(spark, [(1, "good words here", "", ""), (2, "bad! bad! bad!", "", ""), (3, None, "", ""), (4, "", "", ""), (5, "bad! bad! bad!", "", "")])
    rows = {r.doc_id: r for r in quality.score_quality(asked, model).collect()}
    assert rows[1].predicted == 1 and rows[2].predicted == 0 == rows[5].predicted and rows[3].score == rows[4].score == 0.5 and rows[1].id == "y"
    none = quality.fit_quality_model(spark.createDataFrame([], "text string, quality int"))
    assert {r.score for r in quality.score_quality(asked, none).collect()} == {0.5}


# Pipeline


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    (_, by_lang), (_, near), (_, clean), (_, mix), (_, shard) = corpus_pipeline.STAGES
    kept = by_lang(spark, docs, sf).cache()
    assert kept.columns == docs.columns and kept.count() >= 0.98 * docs.count()
    rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    single = near(spark, kept, sf).cache()
    want = {label for _, label in brute_components(rows, 5, 80).values()}
    assert {r.doc_id for r in single.select("doc_id").collect()} == want and single.count() == len(want)
    left = clean(spark, single, sf).cache()
    hit = decontaminate(single, spark.read.parquet(f"{sf}/benchmark.parquet")).where("contaminated").count()
    assert left.columns == docs.columns and left.count() == single.count() - hit
    mixed = mix(spark, left, sf).cache()
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert shard(spark, mixed, sf).count() == mixed.count()


def test_pipeline_leaves_extra_columns_alone(spark, sf):
    """Columns that are named like those the stages use inside come back as they were; the last row of a kind is odd."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    names = ["score", "lang_pred", "clean_key", "times", "_time", "row", "digest", "number", "known", "text_key", "component_id", "a.b"]
    extra = docs.select("*", *[F.concat(F.lit(f"{c}:"), "doc_id").alias(c) for c in names])
    odd = spark.createDataFrame([(None, None, None, None), (900, "", None, "s"), (901, None, "en", None)], "doc_id long, text string, lang string, source string")
    extra = extra.unionByName(odd, allowMissingColumns=True)
    want = {r.doc_id: tuple(r) for r in extra.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, sf)
        assert out.columns == extra.columns
        got = out.collect()
        assert len(got) > 20 and all(want[r.doc_id] == tuple(r) for r in got), name
    assert corpus_pipeline.sharding_stage(spark, extra, sf).count() == len(want)


def test_pipeline_of_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


def test_pipeline_rows_that_share_an_id(spark, sf):
    _, near, clean, mix, _ = (stage for _, stage in corpus_pipeline.STAGES)
    text = lambda k: " ".join(f"{k}{i}" for i in range(40))
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (7, text("c")), (7, text("d")), (7, text("d")), (8, text("a") + " end")]
    rows += [(9, ""), (9, ""), (10, ""), (None, None)]
    got = [(r.doc_id, r.text) for r in near(spark, frame(rows), sf).collect()]
    want = [(None, text("b")), (7, text("c")), (7, text("d")), (8, text("a") + " end"), (9, ""), (10, ""), (None, None)]
    assert sorted(got, key=str) == sorted(want, key=str)

    items = spark.read.parquet(f"{sf}/benchmark.parquet").where(F.size(F.split("text", " ")) >= 10)
    leak = text("e") + " " + items.first().text
    rows = [(1, text("a")), (1, leak), (None, text("b")), (None, leak), (None, None), (2, "")]
    got = [(r.doc_id, r.text) for r in clean(spark, frame(rows), sf).collect()]
    assert sorted(got, key=str) == sorted([r for r in rows if r[1] != leak], key=str)

    rows = [(None, text(k)) for k in "abcdef"] + [(1, text("g")), (1, text("g")), (1, text("h"))]
    got = [(r.doc_id, r.text) for r in mix(spark, frame(rows), sf).collect()]  # one source: every row once
    assert sorted(got, key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("languages", [1, 2, 3, 4])
def test_pipeline_rejects_unlearned_scripts(spark, sf, languages):
    learned = {"en": "the cat and the dog", "de": "der hund und die katze", "fr": "le chat et le chien", "es": "el gato y el perro"}
    rows = [(10 * k + i, t, lang) for k, (lang, t) in enumerate(list(learned.items())[:languages]) for i in range(10)]
    odd = [(100, "漢字 仮名 文字", None), (101, "漢字 仮名 文字 " * 30 + "the", None), (102, "123", None), (103, None, None)]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows + odd], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.language_stage(spark, frame, sf).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
