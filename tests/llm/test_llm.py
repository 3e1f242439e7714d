"""Each operator against a plain version, and on nulls, empty and long texts, repeated rows, other columns and empty tables."""

import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from sparkwell.llm import exact_dedup, jaccard_join, language_id, lm_score, packing, piece_codec, quality_rules, secret_scan, token_files, toxicity  # noqa: E402
from sparkwell.llm.common import fold  # noqa: E402
from sparkwell.llm.queries import ORACLES, QUERIES  # noqa: E402
from sparkwell.llm.tokens import Encoder, tokenizer_path  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, `set_key` int"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls, empty, blank and long texts, copies, repeated rows, and columns named like results."""
    rnd = random.Random(3)
    vocabulary = ["the", "of", "und", "der", "la", "que", "Idiot", "été", "x" * 70, "1,5", "tok"] + [f"w{i}" for i in range(60)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    base = prose(120)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", " \n\t ", "!!! 123", "one two", "one  TWO", base, base, " ".join(near), base.upper(), prose(9000), "Größe ▁ 語 \u0000 İΣ"]
    texts += [prose(rnd.randint(1, 80)) for _ in range(30)]
    texts += [f'x token = "a1b2c3d4e5f6{i % 3}"; AKIA{"B1" * 9} {"0af" * 10} password: hi' for i in range(6)]
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 4}", len(t or ""), "a", "b", 1) for i, t in enumerate(texts)]
    rows += [rows[6], rows[0], (None, "no id here", "en", "s1", 10, "a", "b", 1)]
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, sf_dir):
    _, problems = compare(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name])
    assert not problems


# --- exact dedup


@pytest.mark.parametrize("key_bits, capacity, cell_bits", [(64, 1 << 16, 12), (3, 2, 2), (64, 3, 2)])
def test_exact_copies(odd, key_bits, capacity, cell_bits):
    got = exact_dedup.find_copies(odd, key_bits, capacity, cell_bits).collect()
    rows = pairs(odd)
    assert len(got) == len(rows)
    for r in got:
        same = [i for i, t in rows if (t or "") == (r["text"] or "")]
        keep = max((i for i in same if i is not None), default=None)
        digest = hashlib.sha256((r["text"] or "").encode()).hexdigest()
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (keep, len(same), r["doc_id"] == keep, digest)


def test_directory_splits_until_buckets_fit(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("key"))
    found = exact_dedup.directory(keys, capacity=20, cell_bits=3).collect()
    assert sum(r["entries"] for r in found) == 500 and max(r["entries"] for r in found) <= 20
    assert sum(2.0 ** -r["depth"] for r in found) == 1.0  # the buckets cover every key once


# --- n-gram Jaccard join


def test_components(odd, none):
    known = odd.filter("doc_id IS NOT NULL")
    got = jaccard_join.jaccard_components(known).collect()
    want = brute.jaccard(pairs(known))
    assert len(got) == known.count()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert jaccard_join.jaccard_components(none).count() == 0
    assert jaccard_join.jaccard_components(odd).count() == odd.count()


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_chains(spark, seed):
    """Families of near copies near the limit, whose members link only through others."""
    rnd = random.Random(seed)
    rows, n = [], 0
    for _ in range(6):
        text = [f"v{rnd.randint(0, 400)}" for _ in range(rnd.randint(30, 90))]
        for _ in range(25):
            text = list(text)
            for _ in range(rnd.randint(0, 2)):
                text[rnd.randrange(len(text))] = f"v{rnd.randint(0, 400)}"
            if rnd.random() < 0.3:
                text = text + ["end"] * rnd.randint(1, 3)
            rows.append((n, " ".join(text)))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == brute.jaccard(rows)


# --- secret scan


def test_secrets_of_odd_rows(odd, none):
    rows = {r["doc_id"]: r for r in secret_scan.scan_secrets(odd, F.col("source"), F.col("source")).collect()}
    assert len(rows) == len({i for i, _ in pairs(odd)})
    hit = rows[42]
    assert (hit["n_assign"], hit["n_access"], hit["n_hex"]) == (1, 1, 1) and hit["spans"].startswith("assign:2:")
    assert rows[0]["spans"] == "" and rows[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert secret_scan.scan_secrets(none, F.col("source"), F.col("source")).count() == 0


def test_ownership_separates_examples(spark):
    rows = [(i, "key token=AbCdEf123456ghij", f"o{i}") for i in range(9)] + [(99, "é token=Zz98yy76xx54ww32", "o1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r for r in secret_scan.scan_secrets(docs, F.col("source"), F.col("source")).collect()}
    assert (got[0]["n_example"], got[0]["n_live"]) == (1, 0) and (got[99]["n_example"], got[99]["n_live"]) == (0, 1)
    assert got[99]["spans"] == "assign:2:24"
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs, F.col("source"), F.col("source")).collect()}
    assert clean[0] == "key <example>" and clean[99] == "é <secret>"


def test_redaction_keeps_rows_and_columns(odd):
    out = secret_scan.redact(odd, F.col("source"), F.col("source"))
    assert out.columns == odd.columns and out.count() == odd.count()
    assert not [r for r in out.collect() if r["text"] and "AKIA" in r["text"]]


# --- language, toxicity


def test_languages(spark, sf_dir, odd, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.learn(docs, fold("doc_id", 4) != 2)
    held = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(fold("doc_id", 4) == 2).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    got = {r["doc_id"]: r for r in language_id.identify(odd, model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (0, 1, 2, 3)) and got[6]["lang_pred"] != "und"
    assert language_id.identify(none, model).count() == 0
    assert not language_id.learn(none, F.lit(True)).languages


def test_mixture_of_more_languages_than_are_always_tried(spark):
    """Seven languages with letters of their own: sets grow as long as a language pays."""
    letters = ["abcd", "efgh", "ijkl", "mnop", "qrst", "uvwx", "yz\u00e4\u00f6"]
    text = lambda own, n, seed: " ".join("".join(random.Random(f"{seed}-{i}").choices(own, k=5)) for i in range(n))
    rows = [(10 * k + i, text(own, 80, f"{k}{i}"), f"l{k}") for k, own in enumerate(letters) for i in range(6)]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), F.lit(True))
    mixed = [" ".join(text(own, 60, f"m{k}") for k, own in enumerate(letters[:n])).encode() for n in (1, 3, 6, 7)]
    share, _, _ = language_id.infer(mixed, model)
    assert [int((s > 0.5 / 7).sum()) for s in share] == [1, 3, 6, 7]


def test_mixture_of_two_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.learn(docs, F.lit(True))
    by = {lang: " ".join(r["text"] for r in docs.filter(F.col("lang") == lang).limit(5).collect()) for lang in ("en", "de")}
    share, _, _ = language_id.infer([by["en"].encode(), (by["en"][:3000] + " " + by["de"][:1000]).encode()], model)
    found = dict(zip(model.languages, share[1]))
    assert share[0].max() > 0.95 and 0.5 < found["en"] < 0.9 and 0.1 < found["de"] < 0.5


def test_automaton_against_edit_distance():
    terms = ["idiot", "worthless", "scum", "trash"]
    machine = toxicity.Automaton(terms)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i, *[0] * len(b)], row
            for j, y in enumerate(b, 1):
                row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
        return row[-1]

    rnd = random.Random(4)
    for _ in range(4000):
        word = list(rnd.choice(terms))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(1, len(word))
            word[at : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "t", "s"])
        word = "".join(word)
        near = [edits(word[1:], t[1:]) for t in terms if word[0] == t[0] and edits(word[1:], t[1:]) <= toxicity.edits_allowed(t)]
        assert machine.distance(word) == min(near, default=None)


def test_automaton_against_plain_edit_distance():
    """Edits anywhere, the first letter included, and one in terms of four letters."""
    terms = ["idiot", "worthless", "scum", "stupid", "cad"]
    machine = toxicity.Automaton(terms)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i, *[0] * len(b)], row
            for j, y in enumerate(b, 1):
                row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
        return row[-1]

    assert [machine.distance(w) for w in ("1diot", "ldiot", "tupid", "sstupid", "scvm", "scuum", "orthles")] == [1, 1, 1, 1, 1, 1, 2]
    most = {"idiot": 1, "worthless": 2, "scum": 1, "stupid": 1, "cad": 0}
    rnd = random.Random(6)
    for _ in range(4000):
        word = list(rnd.choice(terms))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(word))
            word[at : at + rnd.randint(0, 1)] = rnd.choice(["", "a", "t", "s", "o"])
        word = "".join(word)
        assert machine.distance(word) == min((e for t in terms if (e := edits(word, t)) <= most[t]), default=None), word


def test_masked_first_letter_is_a_hit():
    model = toxicity.Model(["stupid", "scum"], ["slum"], toxicity.PRIOR.tolist())
    assert [(w, e) for _, w, e, *_ in model.hits("you *tupid $cum, a slum")] == [("tupid", 1), ("$cum", 1)]


def test_quotation_weighs_less():
    model = toxicity.Model(["idiot"], [], toxicity.PRIOR.tolist())
    assert model.score("you are an idiot") > 0.7 > model.score('he said "idiot" is a rude word')
    assert model.score("you idiott fool") > model.score("a fine day")


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, 1 if i in (6, 7, 8) else 0, 1) for i in range(30)] + [(31, None, 0)], "doc_id bigint, toxic int, quality int")
    model = toxicity.learn(odd, labels, F.lit(True))
    got = toxicity.score_toxicity(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert toxicity.score_toxicity(none, toxicity.learn(none, labels.limit(0), F.lit(True))).count() == 0


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [r for r in QUERIES["op1_toxicity"](spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)


# --- LM scoring


def test_lm_against_plain_counts(odd, monkeypatch):
    docs = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).cache()
    kept = {}
    fit = lm_score.fit_weights
    monkeypatch.setattr(lm_score, "fit_weights", lambda *a: kept.setdefault("w", fit(*a)))
    got = {r["doc_id"]: r for r in lm_score.score_texts(docs, fold("doc_id", 7) != 2, fold("doc_id", 11) == 3).collect()}
    want = brute.interpolated(pairs(docs), kept["w"], lambda c: int(lm_score._bucket_of(np.array([c]))[0]))
    assert set(got) == set(want)
    assert all(abs(got[i]["score"] - want[i]) < 1e-6 * max(1, abs(want[i])) for i in want)
    assert np.allclose(kept["w"].sum(axis=1), 1)


@pytest.mark.parametrize("known, dense", [(1, 1), (7, 3), (40, 5)])
def test_lm_of_rare_contexts(odd, known, dense, monkeypatch):
    """Every context has its bigram term, whatever the share of words whose counts do not travel."""
    docs = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).cache()
    kept = {}
    fit = lm_score.fit_weights
    monkeypatch.setattr(lm_score, "fit_weights", lambda *a: kept.setdefault("w", fit(*a)))
    train, deleted = fold("doc_id", 7) != 2, fold("doc_id", 11) == 3
    got = {r["doc_id"]: r for r in lm_score.score_texts(docs, train, deleted, known, dense).collect()}
    want = brute.interpolated(pairs(docs), kept["w"], lambda c: int(lm_score._bucket_of(np.array([c]))[0]))
    assert set(got) == set(want)
    assert all(abs(got[i]["score"] - want[i]) < 1e-6 * max(1, abs(want[i])) for i in want)
    here = kept.pop("w")
    whole = {r["doc_id"]: r for r in lm_score.score_texts(docs, train, deleted).collect()}
    assert np.allclose(here, kept["w"], atol=0.02)
    assert all((got[i]["n_tokens"], got[i]["n_known"]) == (whole[i]["n_tokens"], whole[i]["n_known"]) for i in want)
    assert all(abs(got[i]["base_score"] - whole[i]["base_score"]) < 1e-6 * max(1, abs(whole[i]["base_score"])) for i in want)


def test_lm_of_odd_rows(odd, none):
    assert lm_score.score_texts(odd, F.lit(True), fold("doc_id", 2) == 1).count() == odd.count()
    assert lm_score.score_texts(odd, F.lit(False), F.lit(False)).filter("n_known = 0").count() == odd.count()
    assert lm_score.score_texts(none, F.lit(True), F.lit(False)).count() == 0


# --- quality rules


def test_quality_of_odd_rows(odd, none):
    got = quality_rules.measure(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        if r["doc_id"] in (0, 1, 2):
            assert (r["n_words"], r["base_failed"], r["kept"]) == (0, True, False)
    assert quality_rules.measure(none).count() == 0


# --- tokens


def fuzz(n, seed=5):
    rnd = random.Random(seed)
    parts = list("ab é.,;:!?'s \n\t\x1c\x1d   $#1²ⅧéΣσİßñ<|>'\u0085​語▁") + ["<|endoftext|>", "'re", "  ", "\n\n", " \n", "word", "x."]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_is_the_library(name):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(name))
    texts = fuzz(5000)
    for ordinary in (False, True):
        library.encode_special_tokens = ordinary
        mine = Encoder(tokenizer_path(name), ordinary=ordinary).encode(texts)
        for text, ids, other in zip(texts, mine, library.encode_batch(texts, add_special_tokens=False)):
            assert np.frombuffer(ids, "<u4").tolist() == other.ids, text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_every_latin_letter_beside_other_characters(name):
    """The library's plain call is the only expectation: all letters up to U+024F and their lower case, alone and in words."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(name))
    letters = [chr(c) for c in range(0x20, 0x250)] + ["\u0259", "\u0254", "\u2c65", "\u0307"]
    rnd = random.Random(8)
    texts = [t for x in letters for t in (f"{x} \U0001f600", f"A{x}b{x} \u8a9e", f"\u8a9e a{x}. {x}{x}", x)]
    texts += ["".join(rnd.choice(letters + [" ", " ", "\U0001f600", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>"]) for _ in range(25)) for _ in range(3000)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "x<|ENDOFTEXT|>y", "  <|endoftext|>  \n", "\u018fLAQ\u018f \U0001f600"]
    for text, ids, other in zip(texts, Encoder(tokenizer_path(name)).encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == other.ids, text


def test_codes_round_trip():
    rnd = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (5, 3), (1000, 300), (200_000, 70_000)):
        ids = rnd.integers(0, top, n).astype("<u4")
        assert (token_files.decode_ids(*token_files.encode_ids(ids), n) == ids).all()


def test_token_files_of_odd_rows(odd, none, monkeypatch):
    import zlib

    path = tokenizer_path("word_bpe_49k.json")
    got = token_files.read_token_files(token_files.write_token_files(odd, path)).orderBy("start").collect()
    ids = dict(zip([t for _, t in pairs(odd)], Encoder(path).encode([t for _, t in pairs(odd)])))
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    found = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["ids_crc32"]) for r in got)
    assert found == sorted((i if i is not None else -1, zlib.crc32(ids[t] + (1).to_bytes(4, "little"))) for i, t in pairs(odd))
    assert [r["doc_id"] for r in got][1:] == sorted(r["doc_id"] for r in got if r["doc_id"] is not None)
    assert token_files.read_token_files(token_files.write_token_files(none, path)).count() == 0


def test_packing_of_odd_rows(odd, none):
    path = tokenizer_path("byte_bpe_50k.json")
    docs = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = pairs(docs)
    ids = {i: np.frombuffer(x, "<u4").tolist() + [1] for (i, _), x in zip(rows, Encoder(path).encode([t for _, t in rows]))}
    for targets in (None, {"s1": 5.0, "s2": 0.5}):
        assert brute.pack_faults(packing.pack(docs, path, targets, quantum=64).collect(), ids) == 0
    assert packing.pack(none, path).count() == 0
    assert packing.pack(odd, path).agg(F.sum("length")).first()[0] >= sum(map(len, ids.values()))


def test_windows_hold_the_target_shares(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 3 == 0, "a").otherwise("b"))
    got = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), {"a": 1.0, "b": 1.0}).join(docs.select("doc_id", "source"), "doc_id")
    share = got.filter("sequence_id < 10").groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).collect()
    assert share and all(abs(r["n"] - 1024) <= packing.QUANTUM for r in share)


def test_every_target_has_its_own_queue(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(packing, "OWN_QUEUES", 1)
    monkeypatch.setattr(packing, "SHARED", 1)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("source", F.element_at(F.array(*map(F.lit, "aabcd")), (F.col("doc_id") % 5 + 1).cast("int")))
    path = tokenizer_path("byte_bpe_50k.json")
    got = packing.pack(docs, path, dict.fromkeys("abcd", 1.0)).join(docs.select("doc_id", "source"), "doc_id")
    share = {(r["sequence_id"], r["source"]): r["n"] for r in got.filter("sequence_id < 4").groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).collect()}
    assert all(abs(share.get((i, s), 0) - 512) <= packing.QUANTUM for i in range(4) for s in "abcd")
    with pytest.raises(ValueError, match="typo"):
        packing.pack(docs, path, {"a": 1.0, "typo": 1.0})


# --- pieces


def test_pieces_against_unigram_search():
    sentencepiece = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    path = tokenizer_path("piece_bpe_32k.model")
    model = proto.ModelProto()
    model.ParseFromString(Path(path).read_bytes())
    model.trainer_spec.model_type = 1  # the same pieces and scores, searched for the best sum
    for piece in model.pieces:
        piece.score = max(piece.score, -1e6)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    codec = piece_codec.Pieces(path)
    rnd = random.Random(2)
    for _ in range(3000):
        word = "".join(rnd.choice("theraonisdéüßñ.,'x1") for _ in range(rnd.randint(1, 14)))
        assert np.frombuffer(codec.encode(word), "<u4").tolist() == library.encode(word), word


def test_pieces_stream_and_round_trip():
    codec = piece_codec.Pieces(tokenizer_path("piece_bpe_32k.model"))
    texts = fuzz(2000) + ["a" * 5000, " ".join(["then"] * 3000), "nospacebutlong" * 400]
    for text in texts:
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        if text:
            assert np.fromiter(codec.stream(" " + text), "<u4").tobytes() == ids


def test_pieces_of_odd_rows(odd, none):
    got = piece_codec.round_trip(odd, tokenizer_path("piece_bpe_32k.model")).collect()
    assert len(got) == odd.count() and all(r["exact"] for r in got)
    assert piece_codec.round_trip(none, tokenizer_path("piece_bpe_32k.model")).count() == 0


# --- pipeline


def test_pipeline_of_odd_rows(spark, odd, tmp_path):
    docs = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text", "lang", "source", "n_chars")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    rows = dict(pairs(docs))
    from sparkwell.llm.common import stored

    kept = []
    state = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = stored(stage(spark, state, str(tmp_path)), "stage")
        assert state.columns == docs.columns, name
        kept.append({r["doc_id"] for r in state.collect()})
    assert kept[0] == {i for i, t in rows.items() if t and any(map(str.isalpha, t))}
    assert kept[1] == {max(i for i in kept[0] if rows[i] == t) for t in {rows[i] for i in kept[0]}}
    groups = brute.jaccard([(i, rows[i]) for i in sorted(kept[1])])
    assert kept[2] == kept[3] == {i for i in kept[1] if groups[i][1] == i}
    path = tokenizer_path("byte_bpe_50k.json")
    final = pairs(state)
    ids = {i: np.frombuffer(x, "<u4").tolist() + [1] for (i, _), x in zip(final, Encoder(path).encode([t for _, t in final]))}
    assert brute.pack_faults(corpus_pipeline.run(spark, str(tmp_path)).collect(), ids) == 0
