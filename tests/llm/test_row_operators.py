"""Operators that judge each text on its own, against direct computations."""

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightledger.llm import byte_gru, histogram_packing, license_scan, nbsvm, quality_rules
from tests.llm.fixtures import EMPTY, MENU, PROSE, documents, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- line rules ---------------------------------------------------------------------------------------


def base_measures(text):
    text = text or ""
    ws = WORD.findall(text)
    windows = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    repeated = {j for i in range(len(ws) - 7) if windows[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(ws) < 20 or 100 * len(repeated) > 30 * len(ws)
    return len(ws), sum(map(len, ws)), symbols, again, len(repeated), failed


def test_line_quality_measures(spark):
    draw = random.Random(2)
    rows = odd_rows() + [(100 + k, " ".join(draw.choice("ab c\nd é#|".split(" ")) for _ in range(draw.randint(0, 90)))) for k in range(60)]
    rows += [(300, "a b c d e f g h " * 2), (301, "\n".join(["same line here"] * 3 + ["other", " ", " "])), (302, "x" * 50_000)]
    got = quality_rules.line_quality(documents(spark, rows)).collect()
    mine = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert mine == sorted((str(i), *base_measures(t)) for i, t in rows)
    assert not any(r.kept for r in got if r.base_failed)


def test_line_quality_verdicts(spark):
    long = PROSE + "\nSign up for our newsletter\n" + MENU
    menus = "\n".join(MENU.replace("home", f"home{k}") for k in range(6))
    marked = " ".join(w + "***" for w in PROSE.split())
    rows = {r.doc_id: r for r in quality_rules.line_quality(documents(spark, [(1, PROSE), (2, long), (3, menus), (4, marked), (5, None)])).collect()}
    assert [rows[i].kept for i in (1, 2, 3, 4, 5)] == [True, True, False, False, False]
    assert rows[1].clean_text == PROSE
    assert rows[2].clean_text == PROSE and rows[2].n_failed_lines == 2
    assert quality_rules.line_quality(spark.createDataFrame([], EMPTY)).count() == 0


# -- language -----------------------------------------------------------------------------------------


def test_gradient_is_that_of_the_loss():
    draw = np.random.default_rng(1)
    net = byte_gru.start(["a", "b", "c"], 4)
    ids, label = draw.integers(0, 257, (5, 7)), np.array([0, 1, 2, 0, 1, 2, 0])
    _, grads = byte_gru.gradients(net, ids, label)
    for value, grad in zip(net.parameters(), grads, strict=True):
        at = np.unravel_index(np.argmax(np.abs(grad)), value.shape)
        old, step = value[at], 1e-2
        ends = []
        for x in (old + step, old - step):
            value[at] = x
            ends.append(byte_gru.gradients(net, ids, label)[0])
        value[at] = old
        assert grad[at] == pytest.approx((ends[0] - ends[1]) / (2 * step), rel=0.02)


def test_languages_are_learned_and_every_byte_counts(spark):
    draw = random.Random(5)
    sounds = {"aa": ["ka", "to", "mi", "ru"], "bb": ["schl", "ück", "erz", "ung"], "cc": ["tion", "eau", "oui", "èr"]}
    say = lambda lang: " ".join("".join(draw.choice(sounds[lang]) for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(8, 60)))
    rows = [(i, say(x), x) for i, x in enumerate(random.Random(6).choices(list(sounds), k=500))]
    kind = "doc_id long, text string, lang string"
    odd = [(None, "kato mi", None), (9001, None, "aa"), (9002, "", "aa"), (9003, "12 34 !", "bb"), (9005, "² ½ ① _ 7", "bb"), (9004, "kato " * 20_000, None)]
    docs = spark.createDataFrame([*rows, *odd], kind)
    net = byte_gru.train(docs, per_label=150, epochs=6)
    got = {r.doc_id: r for r in byte_gru.languages(docs, net).collect()}
    test = [(i, x) for i, _, x in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i, _ in test) and sum(r.held_out for r in got.values()) >= len(test)
    assert sum(got[i].lang_pred == x for i, x in test) >= 0.97 * len(test)
    assert [got[i].lang_pred for i in (9001, 9002, 9003, 9005, 9004, None)] == ["und", "und", "und", "und", "aa", "aa"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[9001].score == 0

    text = ("kato " * 50 + "ückschl " * 30).encode()
    whole = byte_gru.predict(net, [text, b"ka"])[0]
    by_hand = np.zeros(3)
    for a in range(0, len(text), byte_gru.STEPS):
        part = np.frombuffer(text[a : a + byte_gru.STEPS], np.uint8).astype(np.int64)
        ids = np.full((byte_gru.STEPS, 1), byte_gru.PAD)
        ids[: len(part), 0] = part
        by_hand += byte_gru.position_probabilities(net, byte_gru.forward(net, ids)[0])[: len(part), :, 0].sum(axis=0)
    assert whole == pytest.approx(by_hand / len(text), abs=1e-5)


def test_a_hot_id_and_empty_tables_in_language_training(spark):
    """A repeated id is one document of the sample, the first by language and text hash, whatever the number of its rows."""
    texts = [(i, f"{'kato miru' if i % 2 else 'schlück erzung'} {i}", "aa" if i % 2 else "bb") for i in range(40)]
    again = [(1, "schlück", "bb"), (3, texts[3][1], "aa")] * 300
    kind = "doc_id long, text string, lang string"
    nets = [byte_gru.train(spark.createDataFrame(x, kind), per_label=10, epochs=1) for x in (texts, texts + [(3, texts[3][1], "aa")] * 300, texts + again)]
    assert all((a == b).all() for a, b in zip(nets[0].parameters(), nets[1].parameters()))
    assert nets[2].labels == ["aa", "bb"]
    empty = spark.createDataFrame([], kind)
    assert byte_gru.train(empty) is None and byte_gru.languages(empty, None).count() == 0
    odd = documents(spark, [*odd_rows(), *odd_rows()])
    rows = byte_gru.languages(odd, nets[0]).collect()
    assert len(rows) == 2 * len(odd_rows())
    texts_of = {i: t for i, t in odd_rows() if sum(j == i for j, _ in odd_rows()) == 1}
    for r in rows:
        if r.doc_id in texts_of:
            t = texts_of[r.doc_id]
            if t and any(c.isalpha() for c in t):
                p = byte_gru.predict(nets[0], [t.encode()])[0]
                assert (r.lang_pred, r.score) == (nets[0].labels[int(p.argmax())], pytest.approx(float(p.max()), abs=1e-5))
            else:
                assert (r.lang_pred, r.score) == ("und", 0.0)


def test_language_without_training_rows(spark):
    docs = documents(spark, [(1, PROSE)]).drop("lang").selectExpr("*", "cast(null as string) as lang")
    row = byte_gru.languages(docs, byte_gru.train(docs)).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)


# -- quality classifier -------------------------------------------------------------------------------


def test_quality_of_unseen_documents(spark):
    draw = random.Random(8)
    ws = PROSE.split()
    good = lambda: " ".join(draw.choice(ws) for _ in range(draw.randint(10, 80)))
    bad = lambda: " ".join(draw.choice(ws) + draw.choice(["***", "%%%", "&&&"]) for _ in range(draw.randint(10, 80)))
    label = {i: int(draw.random() < 0.8) for i in range(400)}
    rows = [(i, good() if y else bad()) for i, y in label.items()]
    labels = spark.createDataFrame([(i, y) for i, y in label.items()] + [(None, 1), (5000, None), (7, label[7])], "doc_id long, quality int")
    model = nbsvm.train(documents(spark, rows), labels)
    got = {r.doc_id: r for r in nbsvm.quality_scores(documents(spark, rows + [(900, None), (901, ""), (902, "x")]), model).collect()}
    unseen = [i for i in label if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(unseen) > 40 and all(got[i].held_out for i in unseen)
    assert sum(got[i].predicted == label[i] for i in unseen) >= 0.97 * len(unseen)
    assert got[900].score == got[901].score and 0 <= got[900].score <= 1
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())


def test_repeated_rows_and_contradictory_labels_in_quality_training(spark):
    ws = PROSE.split()
    rows = [(i, " ".join(ws[i % 20 : i % 20 + 12]) + (" ***" if i % 3 else "")) for i in range(90)]
    label = [(i, int(i % 3 == 0)) for i in range(90)]
    kind = "doc_id long, quality int"
    plain = nbsvm.train(documents(spark, rows), spark.createDataFrame(label, kind))
    same = nbsvm.train(documents(spark, rows + rows[5:9] * 50), spark.createDataFrame(label + label[3:8] * 400, kind))
    both = nbsvm.train(documents(spark, rows), spark.createDataFrame(label + [(i, 1) for i in range(90)], kind))  # the smaller counts
    small = nbsvm.train(documents(spark, rows), spark.createDataFrame(label + label[:1] * 5000, kind), sample=60)
    for model in (same, both):
        assert (model.weights == plain.weights).all() and model.slope == plain.slope
    assert (small.weights != 0).any()
    empty = spark.createDataFrame([], EMPTY)
    assert nbsvm.quality_scores(empty, nbsvm.train(empty, spark.createDataFrame([], kind))).count() == 0
    flags = np.zeros(nbsvm.DIMENSIONS, bool)
    for r in nbsvm.quality_scores(documents(spark, [(1, PROSE), (2, "x " * 2_000_000), (3, None)]), plain).collect():
        text = {1: PROSE, 2: "x " * 2_000_000, 3: ""}[r.doc_id].encode()
        grams = {text[i : i + 2] for i in range(len(text) - 1)} | {text[i : i + 3] for i in range(len(text) - 2)}
        ids = sorted({g[0] << 8 | g[1] if len(g) == 2 else nbsvm.PAIRS + ((g[0] << 16 | g[1] << 8 | g[2]) * 2654435761 % 2**32 >> 15) for g in grams})
        assert ids == nbsvm.indicators(text, flags).tolist()
        x = plain.weights[ids].astype(float).sum() / (plain.squares[ids].astype(float).sum() ** 0.5 + 1e-12) + plain.bias
        score = 1 / (1 + np.exp(-(plain.slope * x + plain.shift)))
        assert r.score == pytest.approx(score, abs=1e-6) and r.predicted == int(r.score >= 0.3)


def test_dual_coordinate_descent_separates_and_one_class_is_its_share():
    flags = np.zeros(nbsvm.DIMENSIONS, bool)
    texts = [(b"abab" * k, 1) for k in range(1, 30)] + [(b"xyxy" * k, 0) for k in range(1, 10)]
    examples = [(nbsvm.indicators(t, flags), y) for t, y in texts]
    assert not flags.any()
    model = nbsvm.fit(examples)
    assert all((model.margin(ids) > 0) == y for ids, y in examples)
    assert nbsvm.fit([e for e in examples if e[1]]).score(np.array([3.0]))[0] == pytest.approx(1, abs=1e-5)
    assert nbsvm.fit([]).score(np.array([0.0]))[0] == pytest.approx(0.5)


# -- packing ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("rows_a_shard", [1, 1000])
def test_pieces_are_exact_and_sequences_gapless(spark, monkeypatch, rows_a_shard):
    monkeypatch.setattr(histogram_packing, "SHARD_ROWS", (rows_a_shard, 200_000))
    rows = [*odd_rows(), (50, "special <|endoftext|> text"), (51, PROSE * 40)]
    got = histogram_packing.pack(documents(spark, rows), size=128).collect()
    encoder = histogram_packing.Encoder("byte_bpe_50k").whole
    want = []
    for i, t in rows:
        ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        n, first = len(ids), len(ids) % 128 or 128
        cuts = [0, n] if n <= 128 else [0, *range(first, n + 1, 128)]
        want += [(str(i), k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 128


def test_plan_packs_as_well_as_best_fit_on_documents():
    draw = random.Random(9)
    for _ in range(20):
        size = draw.choice([10, 64, 100])
        lengths = [draw.randint(1, size) for _ in range(draw.randint(0, 300))]
        used, ranks = {}, Counter()
        for length, rank, items, per, first, offset in histogram_packing.plan(dict(Counter(lengths)), size):
            for k in range(items):
                used.setdefault(first + k // per, []).append((offset + (k % per) * length, length))
                assert (length, rank + k) not in ranks
                ranks[length, rank + k] += 1
        assert Counter(n for n, _ in ranks) == Counter(lengths)
        for parts in used.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= size
        rooms = []
        for n in sorted(lengths, reverse=True):
            fit = min((r for r in rooms if r >= n), default=None)
            if fit is not None:
                rooms.remove(fit)
            rooms.append((size if fit is None else fit) - n)
        assert len(used) == len(rooms)


def test_both_tokenizer_libraries_agree():
    encoder = histogram_packing.Encoder("byte_bpe_50k")
    texts = [t for _, t in odd_rows() if t] + ["Ça l'été — «où» ÄÖÜ ß", "\t\n  x \r\n y  ", "it's I'LL 12345 3.14", "x" * 300, "a b c"]
    for t in texts:
        assert encoder.ids(t) == encoder.whole.encode(t, add_special_tokens=False).ids
        if "<|" not in t:
            assert encoder.fast.encode_ordinary(t) == encoder.whole.encode(t, add_special_tokens=False).ids


def test_very_long_runs_are_packed_like_any_text(spark):
    """White space on which the fast library ends its stack, or takes the square of its length."""
    rows = [(1, " " * 10_000_000), (2, "\n" * 10_000_000), (3, "a" * 5_000_000), (4, "x" + " " * 999 + "y" + " " * 1000 + "\u00a0" * 1000)]
    got = histogram_packing.pieces(documents(spark, rows)).groupBy("doc_id").agg(F.sum("length"), F.sum("ids_crc32")).collect()
    encoder = histogram_packing.Encoder("byte_bpe_50k").whole
    want = []
    for i, t in rows:
        ids = np.array([*encoder.encode(t, add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        want.append((i, len(ids), sum(zlib.crc32(x) for x in [ids[:first], *np.split(ids[first:], range(1024, len(ids) - first, 1024))] if len(x))))
    assert sorted(map(tuple, got)) == want


def test_packing_an_empty_table(spark):
    assert histogram_packing.pack(spark.createDataFrame([], EMPTY)).count() == 0


# -- licenses -----------------------------------------------------------------------------------------


def phrases(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = []
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_license_phrases_and_notices(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy"
    rows = [*odd_rows(), (50, "CC-BY cc, by CC by\nby cc by"), (51, "All rights\nreserved. ALL RIGHTS RESERVED"), (52, "xcc by ccby cc byx")]
    rows += [(60, f"{PROSE} {mit} {PROSE}"), (61, mit.replace("hereby", "herby").replace("person", "persons")), (62, "Permission to leave was granted.")]
    rows += [(63, "Licensed under teh Apache License, Version 2.0 and the GNU General Public License"), (64, "é Licensed under the Apache License Version 2 0")]
    got = license_scan.license_notices(documents(spark, rows)).collect()
    mine = sorted(((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str)
    assert mine == sorted(((str(i), *phrases(t)) for i, t in rows), key=str)
    by = {r.doc_id: r for r in got}
    assert (by[60].labels, by[60].score, by[60].notices) == ("mit", 1.0, "mit:64:77:0") or by[60].notices.startswith("mit:")
    assert by[61].labels == "mit" and 0.9 < by[61].score < 1 and by[61].notices.endswith(":2")
    assert by[62].labels == "" and by[62].score == 0
    assert by[63].labels == "apache-2.0,gpl" and by[63].base_labels == "gpl"
    assert by[64].notices == "apache-2.0:1:8:0"
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in got if r.base_labels)


def test_pigeonhole_seeds_lose_no_match():
    draw = random.Random(10)
    notice = license_scan.Notice("x", "released under the mit license", 2)
    for _ in range(300):
        text = list("released under the mit license")
        for _ in range(draw.randint(0, 2)):
            k = draw.randrange(len(text))
            kind = draw.random()
            if kind < 0.4:
                text[k] = draw.choice("abcxyz")
            elif kind < 0.7:
                del text[k]
            else:
                text.insert(k, draw.choice("abcxyz"))
        line = (" some words " + "".join(text) + " and more ").encode()
        found = notice.find(line)
        assert len(found) == 1 and found[0][2] <= 2


def fewest_edits(notice, line):
    """Of the whole notice to any part of the line."""
    row = [0] * (len(line) + 1)
    for i, x in enumerate(notice, 1):
        last, row = row, [i]
        for j, y in enumerate(line, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return min(row)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_an_edited_notice_before_a_better_one_stays():
    text = "under the terms of the gnu general public license"
    notice = license_scan.Notice("gpl", text, 4)
    found = notice.find(f" under the terms of gnu general public license or {text} ".encode())
    assert [edits for *_, edits in found] == [4, 0] and found[1][:2] == (50, 99)


def test_adjacent_notices_leave_no_place_between():
    draw = random.Random(12)
    for label, text, most in license_scan.NOTICES:
        notice = license_scan.Notice(label, text, most)
        for _ in range(12):
            parts = []
            for worse in range(draw.randint(2, 4), 0, -1):
                letters = list(text)
                for _ in range(min(most, worse)):
                    letters[draw.randrange(len(letters))] = draw.choice("qxz")
                parts.append("".join(letters))
            line = (" " + draw.choice([" ", " or ", ""]).join(parts) + " ").encode()
            found = notice.find(line)
            assert len(found) >= len(parts)
            ends = [0, *(x for a, b, _ in found for x in (a, b)), len(line)]
            assert ends == sorted(ends)
            for a, b, edits in found:
                assert distance(text.encode(), line[a:b]) == edits <= most
            for a, b in zip(ends[::2], ends[1::2], strict=True):
                assert fewest_edits(text.encode(), line[a:b]) > most


def test_licenses_of_a_long_text_with_many_phrases():
    """Ten megabytes, a phrase every other word: places are counted from the blanks, not from the start each time."""
    notices = [license_scan.Notice(*x) for x in license_scan.NOTICES]
    text = "cc by " * 1_600_000 + "all rights reserved"
    start = time.monotonic()
    n_words, n_base, first, last, base, *_ = license_scan.scan(text, notices)
    assert (n_words, n_base, first, last, base) == (3_200_003, 1_600_001, 0, 3_200_000, "cc-by,reserved")
    assert time.monotonic() - start < 60


def test_licenses_of_an_empty_table(spark):
    assert license_scan.license_notices(spark.createDataFrame([], EMPTY)).count() == 0
