"""Operators 2, 4, 5, 6, 9 and 10."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from llm_cases import EDGES, frame

from stockroom.llm import bpe, decontam, langid, pieces, pii, quality, token_files

SF = "/root/testdata/sf0.01"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")

# --- 2: personal data ----------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


@pytest.mark.parametrize("letters", ["a@.-b+% ", "01.2 5", "0123456789 -", "+0 ().1-9a", "a@b.c1.2.3 -+9(é"])
def test_base_spans_match_the_patterns(letters):
    rnd = random.Random(letters)
    for _ in range(4000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(40)))
        assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "." * 300_000 + "@"):
        pii.base_spans(text)


def test_pii_edges(spark):
    parts = {"email": "a.b@c.de", "ip": "1.2.3.4", "card": "4111 1111 1111 1111", "phone": "+1 (212) 555-0100"}
    text = f"é mail {parts['email']}, ip {parts['ip']} (not 1.2.3.400), card {parts['card']}, tel {parts['phone']}"
    rows = [*EDGES, (50, text)]
    got = {r["doc_id"]: r for r in pii.spans(frame(spark, rows)).collect()}
    r = got[50]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
    assert r["base"] == r["spans"] == ",".join(f"{k}:{text.index(v)}:{text.index(v) + len(v)}" for k, v in parts.items())
    assert all(got[d]["base"] == "" for d in (1, 3, 4, 6, 7))
    assert len(pii.spans(frame(spark, rows)).collect()) == len(rows)
    assert pii.spans(frame(spark, [])).count() == 0


def test_terms_that_only_occur_with_an_entity_are_marked(spark):
    rows = [(i, f"meet Zorbek at {'the' if i % 2 else 'a'} place, zorb@mail.example.com now") for i in range(8)]
    rows += [(100 + i, f"meet someone at the place number{i} now, mail@{i}x.example.com") for i in range(200)]
    rows += [(90, "a text that names Zorbek far from any address"), (91, "Zorbek@mail.example.com")]
    got = {r["doc_id"]: r for r in pii.spans(frame(spark, rows)).collect()}
    # Zorbek: ten documents hold the word, eight near the entity; 'meet' and 'place' are common
    mail = rows[0][1].index("zorb@")
    assert got[0]["spans"] == f"email:{mail}:{mail + 21},term:5:11" and got[90]["spans"] == "term:18:24"
    assert got[91]["spans"] == got[91]["base"] and got[100]["spans"] == got[100]["base"]
    clean = {r["doc_id"]: r["clean"] for r in pii.sanitised(frame(spark, rows)).collect()}
    assert clean[0] == "meet [name] at a place, [email] now" and clean[90] == "a text that names [name] far from any address"


# --- 4 and 5: tokens -----------------------------------------------------------------------------


def _texts(seed, n=400):
    rnd = random.Random(seed)
    letters = " \n\t'aAbst mdrevel'' 019.,-é×Ȁ!\r\x1c\x00 　\x85中²ªǅ\U0001f600thenonm"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(200))) for _ in range(n)]


def test_pieces_match_the_pattern():
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    texts = [t.replace("\x1c", "") for t in _texts(1)]
    found, at = pieces.pieces(pa.array([t.encode() for t in texts], pa.binary()))
    for i, t in enumerate(texts):
        assert [p.decode() for p in found[int(at[i]) : int(at[i + 1])].to_pylist()] == pattern.findall(t)


def test_bpe_matches_tiktoken(spark):
    import tiktoken

    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    rows = [*EDGES, *[(1000 + i, t) for i, t in enumerate([*_texts(2), "ab" * 3000, "<|endoftext|>"])]]
    got = bpe.encoded(frame(spark, rows), RANKS).collect()
    assert len(got) == len(rows)
    want = sorted((d is not None, d or 0, known.encode_ordinary(t or ""), (t or "").encode()) for d, t, *_ in rows)
    import numpy as np

    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist(), bytes(r["decoded"])) for r in got) == want
    assert bpe.encoded(frame(spark, []), RANKS).count() == 0


def test_decoding_hangs_on_the_vocabulary(monkeypatch):
    """Runs of tokens give the same bytes however short, and a token that the vocabulary lacks leaves a gap."""
    codec = bpe.Codec(RANKS)
    texts = [b"", "naïve words, naïve words".encode(), b"", b"plain text", b""]
    ids, at = codec.encode(pa.array(texts, pa.binary()))
    for run in (1, 3, 1 << 20):
        monkeypatch.setattr(bpe, "RUN_TOKENS", run)
        assert codec.decode(ids, at) == texts
    codec.db.execute("DELETE FROM vocabulary WHERE tok = ?", [int(ids[0])])
    spelled = {rank: token for token, rank in codec.ranks.items() if rank != ids[0]}
    assert codec.decode(ids, at)[1] == b"".join(spelled.get(int(i), b"") for i in ids[at[1] : at[2]]) != texts[1]


def test_token_files_match_the_library(spark):
    import numpy as np
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(JSON)
    rows = [r for r in EDGES if r[0] is not None and r[0] != 2] + [(1000 + i, t) for i, t in enumerate([*_texts(3), "a <|endoftext|> b"])]
    got = {r["doc_id"]: r for r in token_files.round_trip(frame(spark, rows), JSON).collect()}
    start = 0
    for d, t, *_ in sorted(rows, key=lambda r: r[0]):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(rows)


def test_token_files_edges(spark):
    got = token_files.round_trip(frame(spark, EDGES), JSON).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in got) == sorted((d is not None, d or 0) for d, *_ in EDGES)
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered][:2] == [None, None] and ordered[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(ordered, ordered[1:]))
    assert token_files.round_trip(frame(spark, []), JSON).count() == 0


# --- 6: decontamination --------------------------------------------------------------------------


def test_decontamination_finds_copies_and_edited_copies(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 7)))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(20)] + [(50, None), (51, "..."), (52, "two words")]
    around = lambda: " ".join(word() for _ in range(rnd.randrange(20, 200)))
    rows, want = [], {}
    for i in range(120):
        text = around()
        if i % 4 == 0:
            item, words = i % 20, items[i % 20][1].split()
            if i % 8 == 0:  # every sixth word changed, one left out, one put in
                words = [word() if k % 6 == 3 else w for k, w in enumerate(words)]
                words = [*words[:10], word(), *words[11:20], *words[21:]]
            text = f"{around()}. {' '.join(words).upper()} {text}"
            want[i] = item
        rows.append((i, text))
    rows += [(None, None), (500, ""), (501, "two words")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contaminated(frame(spark, rows), benchmark).collect()
    assert {r["doc_id"]: r["item_id"] for r in got} == want | {501: 52}
    exact = next(r for r in got if r["doc_id"] == 4)
    assert exact["score"] == 1.0 and rows[4][1][exact["start"] : exact["end"]] == items[4][1].upper()
    kept = decontam.keep_clean(frame(spark, rows), benchmark)
    assert kept.columns == frame(spark, []).columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted((d if d is not None else -1) for d, _ in rows if d not in want and d != 501)


def test_decontamination_keeps_items_of_many_documents(spark):
    items = spark.createDataFrame([(1, "an item that a third of all the documents hold somewhere in their text")], "item_id long, text string")
    rows = [(i, f"text {i} and " + ("an item that a third of all the documents hold somewhere in their text" if i % 3 == 0 else "no item")) for i in range(90)]
    assert decontam.contaminated(frame(spark, rows), items).count() == 30


def test_decontamination_finds_one_version_of_an_item_in_many_documents(spark):
    words = {i: [f"w{i}x{k}" for k in range(30)] for i in (1, 2)}
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in words.items()], "item_id long, text string")
    edited = ["other" if k in (5, 14, 23) else w for k, w in enumerate(words[1])]
    rows = [(i, f"text {i} before {' '.join(edited)} text {i} after") for i in range(50)]
    rows += [(100 + i, f"text {i} before {' '.join(words[2][:18])} text {i} after") for i in range(50)]
    rows += [(200 + i, f"text {i} {' '.join(words[1 + i % 2])}") for i in range(6)] + [(300, "no item")]
    got = {r["doc_id"]: (r["item_id"], r["score"]) for r in decontam.contaminated(frame(spark, rows), items).collect()}
    want = {i: (1, 51 / 60) for i in range(50)} | {100 + i: (2, 36 / 60) for i in range(50)} | {200 + i: (1 + i % 2, 1.0) for i in range(6)}
    assert got == want
    assert [r["doc_id"] for r in decontam.keep_clean(frame(spark, rows), items).collect()] == [300]


def test_words_are_letters_and_digits_of_any_script():
    from stockroom.llm.words import Words, alphanumeric

    texts = ["“Don’t”—naïve\u00a0Zoë, 3½ x²…", "他说：“你好，world2”。", "", "ภาษาไทย ไทย", "한국어 문장。カタカナ", "é\u0301a", "a", "b", "русский—язык", "😀ok😀"]
    got = Words(pa.array([t.encode() for t in texts], pa.binary()), alphanumeric())
    spelled = [bytes(got.body[a:b]).decode() for a, b in zip(got.start, got.end)]
    want = [["don", "t", "naïve", "Zoë".lower(), "3½", "x²"], [*"他说你好", "world2"], [], [*"ภาษาไทยไทย"], ["한국어", "문장", *"カタカナ"], ["é\u0301a"], ["a"], ["b"], ["русский", "язык"], ["ok"]]
    assert [spelled[a:b] for a, b in zip(got.at, got.at[1:])] == want


def test_decontamination_of_scripts_without_spaces(spark):
    item, other = "下列哪一种气体在地球大气中所占的体积比例最大", "“Which gas”—of these—makes up most of the air we breathe"
    items = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    rows = [(1, f"这是一段很长的中文文字，其中的内容包括{item}，以及其他没有关系的句子。"), (2, "这是一段很长的中文文字，没有任何题目，只有没有关系的句子。")]
    rows += [(3, "before:\u00a0which gas of these makes up most of the air “we breathe”"), (4, "none of it")]
    got = {r["doc_id"]: r for r in decontam.contaminated(frame(spark, rows), items).collect()}
    assert {d: (r["item_id"], r["score"]) for d, r in got.items()} == {1: (1, 1.0), 3: (2, 1.0)}
    assert rows[0][1][got[1]["start"] : got[1]["end"]] == item


def test_terms_beside_other_punctuation(spark):
    rows = [(i, f"text{i}。请联系“张霩”，邮箱zorb@mail.example.com，谢谢") for i in range(8)] + [(100 + i, f"谢谢你的邮箱，请联系张三 mail{i}@x{i}.example.com 谢谢") for i in range(200)]
    got = {r["doc_id"]: r["spans"] for r in pii.spans(frame(spark, rows)).collect()}
    at = rows[0][1].index("霩")
    assert f"term:{at}:{at + 1}" in got[0].split(",") and "term" not in got[100]


def _local_score(item, words):
    best, row = 0, [0] * (len(words) + 1)
    for a in item:
        new = [0]
        for k, b in enumerate(words):
            new.append(max(0, row[k] + (2 if a == b else -1), row[k + 1] - 1, new[k] - 1))
        best, row = max(best, *new), new
    return best / (2 * len(item))


def test_decontamination_equals_full_alignment(spark):
    rnd = random.Random(9)
    word = lambda: rnd.choice("abcdefghijklmnopqrstuvwxyzäöü") + str(int(rnd.expovariate(0.1)))
    items = [(i, [word() for _ in range(n)]) for i, n in enumerate([15, 15, 16, 20, 30, 57, 4, 5])]
    rows = [(0, ["other" if k % 4 == 3 else w for k, w in enumerate(items[0][1])]), (1, [x for w in items[4][1] for x in (w, "other")])]
    for i in range(300):
        rate, words = rnd.choice([0.1, 0.2, 0.25, 0.3, 0.4]), []
        for w in items[rnd.randrange(6)][1]:
            kind = rnd.randrange(3) if rnd.random() < rate else 3
            words += [[word()], [], [w, word()], [w]][kind]
        rows.append((10 + i, [*(word() for _ in range(rnd.randrange(40))), *words, *(word() for _ in range(rnd.randrange(40)))]))
    want = {(d, i): s for d, words in rows for i, item in items if (s := _local_score(item, words)) >= 0.5}
    assert {(0, 0), (1, 4)} <= set(want) and 100 < len(want) < 400
    docs = frame(spark, [(d, " ".join(words)) for d, words in rows])
    benchmark = spark.createDataFrame([(i, " ".join(words)) for i, words in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontam.contaminated(docs, benchmark).collect()}
    assert got == want


def test_no_candidate_is_lost_by_the_rarest_places(monkeypatch):
    """Whatever share of further places is looked up, and however short the runs, the candidates stay the same."""
    rnd = random.Random(4)
    word = lambda: f"w{int(rnd.paretovariate(0.6)) % 400}"
    items = [[word() for _ in range(rnd.choice([4, 5, 9, 20, 40]))] for _ in range(60)]
    texts = []
    for _ in range(200):
        own = [w if rnd.random() > 0.3 else word() for w in items[rnd.randrange(60)]]
        texts.append(" ".join([*(word() for _ in range(rnd.randrange(60))), *own]))
    found = decontam.Words(pa.array([t.encode() for t in texts], pa.binary()), decontam.alphanumeric())
    want = None
    for more, run in ((0, 1 << 20), (0.15, 1 << 20), (0.15, 50), (1, 1 << 20)):
        monkeypatch.setattr(decontam, "MORE", more), monkeypatch.setattr(decontam, "RUN_BYTES", run)
        own = decontam.Items(list(range(60)), [" ".join(i).encode() for i in items], 0.5)
        got = list(decontam.matches(found, own, 0.5))
        want = want or got
        assert got == want and len(got) > 100


def test_of_equal_passages_the_first_is_given(spark):
    item = "alpha beta gamma delta epsilon zeta"
    text = f"{item} and then again {item}"
    docs, benchmark = frame(spark, [(1, text)]), spark.createDataFrame([(7, item)], "item_id long, text string")
    rows = decontam.contaminated(docs, benchmark).collect()
    assert [(r["score"], r["start"], r["end"]) for r in rows] == [(1.0, 0, len(item))]


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "some words here and there")], "item_id long, text string")
    assert decontam.contaminated(frame(spark, EDGES), none).count() == 0
    assert decontam.contaminated(frame(spark, []), one).count() == 0
    assert decontam.keep_clean(frame(spark, EDGES), none).count() == len(EDGES)


# --- 9 and 10: models ----------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum((r["score"] >= 0.3) == (r["quality"] == 1) for r in found)
    assert len(found) > 50 and right >= 0.95 * len(found)


def test_quality_edges(spark):
    labels = spark.createDataFrame([(d, i % 2, 0) for i, (d, *_) in enumerate(EDGES)] + [(1, None, 0)], "doc_id long, quality int, toxic int")
    for table in (labels, labels.where("false"), labels.where("quality = 1")):
        got = quality.classify(frame(spark, EDGES), table).collect()
        assert len(got) == len(EDGES) and all(0 <= r["score"] <= 1 for r in got)
    assert quality.classify(frame(spark, []), labels).count() == 0
    want = {d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0 for d, *_ in EDGES}
    assert {r["doc_id"]: r["held_out"] for r in got} == want


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(held) > 200 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert not any(r["reject"] for r in found)


def test_language_edges_and_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(-1, None, "en"), (-2, "", "en"), (-3, "123 !?", "en"), (-4, "中文字符 不是 学习 过 的 语言 " * 20, None), (-5, "qxzj vkqx zzxq jjqk " * 20, None), (None, "the and of with", None)]
    rows = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    got = {r["doc_id"]: r for r in langid.identify(rows).where("doc_id < 0 or doc_id is null").collect()}
    assert all((got[d]["lang_pred"], got[d]["score"], got[d]["reject"]) == ("und", 0.0, True) for d in (-1, -2, -3))
    assert got[-4]["reject"] and got[-5]["reject"] and got[-4]["score"] < 0.1
    assert got[None]["lang_pred"] == "en" and not got[None]["reject"] and not got[None]["held_out"]
    edges = langid.identify(frame(spark, EDGES)).collect()
    assert len(edges) == len(EDGES)
    assert langid.identify(frame(spark, [])).count() == 0
    untaught = langid.identify(frame(spark, [(1, "no language anywhere")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in untaught] == [("und", 0.0)]
    assert langid.keep_identified(frame(spark, EDGES)).columns == frame(spark, []).columns


def test_kneser_ney_probabilities_sum_to_one():
    import numpy as np

    text = pa.array([b"the cat and the hat and that other thing", b"there then"], pa.binary())
    code, _, _ = langid.symbols(text)
    values, counts = np.unique(code, return_counts=True)
    group = pa.table({"lang": ["en"] * len(values), "code": values, "count": counts})
    model = langid._fit(group).to_pylist()[0]
    for context in (int(values[3]) >> 6, 0, (20 << 12) | (8 << 6) | 5):
        codes = (context << 6) + np.arange(64)
        assert abs(np.exp(langid.log_probs(model, codes)).sum() - 1) < 1e-5


PIECES_JSON = public_tokenizers.path("byte_bpe_50k.json")


def test_token_pieces_that_go_and_come_back(monkeypatch):
    """Pieces that the encoder forgot, or moved to its older half, are encoded as the library does."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "KNOWN", 30)
    one, known = token_files.PieceEncoder(PIECES_JSON), Tokenizer.from_file(PIECES_JSON)
    rnd = random.Random(9)
    letters = " \n\t'abcdeéßñ.,!?0123—　\xa0中文<|>sre\x85"
    for _ in range(60):
        texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(40))) for _ in range(20)] + ["a line\nand\r\n\nmore  of it", "<|endoftext|>"]
        got = one.encode(pa.array([t.encode() for t in texts], pa.binary()))
        assert got == [np.array(known.encode(t, add_special_tokens=False).ids, one.size).tobytes() for t in texts]
