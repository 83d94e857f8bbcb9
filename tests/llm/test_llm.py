"""The training-data operators on small tables: SQL or brute force, and rows that are null, empty, repeated or long."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrekey.llm import common, fingerprints, mixing, near_dedup, packing, pii, quality_classifier, quality_rules, separators, substring_dedup, tokens, url_filter
from sparkrekey.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
FIELDS = "doc_id long, text string, lang string, source string, n_chars long, _id long, key string, size long"


def words(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with names that operators use inside."""
    r = random.Random(1)
    long = words(r, 20_000)
    rows = [(1, None, "s"), (2, "", "s"), (3, " \n\t ", None), (4, long, "s"), (4, long, "s"), (5, long, None), (None, words(r, 80), "t"), (6, "one", "t"), (7, "a@b.co 4111 1111 1111 1111", "t"), (None, None, None)]
    return spark.createDataFrame([(i, t, None, s, len(t or ""), 0, "x", 0) for i, t, s in rows], FIELDS).coalesce(2)


RUNS = {
    "op1": lambda d: quality_classifier.classify(d, d.selectExpr("doc_id", "1 AS quality", "0 AS toxic")),
    "op2": pii.find_pii,
    "op3": lambda d: separators.count_tokens(d, tokens.vocabulary()),
    "op4": lambda d: packing.pack(d, tokens.vocabulary()),
    "op5": fingerprints.fingerprint_edits,
    "op6": near_dedup.near_groups,
    "op7": quality_rules.judge_lines,
    "op8": mixing.mix,
    "op9": substring_dedup.repeated_passages,
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_odd_rows_and_empty_tables(odd, name):
    got = RUNS[name](odd)
    n = got.count()
    if name not in ("op4", "op9"):
        assert n == odd.count()
    assert RUNS[name](odd.filter("false")).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, same, name):
    same(QUERIES[name](spark, SF), ORACLES[name], SF)


def test_common_lines_leave_the_text(spark, odd):
    r = random.Random(16)
    rows, want = [], {}
    for i in range(30):
        a, b = words(r, 20), words(r, 20)
        rows.append((i, f"{a}\n\n  Share  this PAGE {i % 10}\n{b}\n\nshare this page 7" if i < 12 else f"{a}\n{b}", "s", 0, "x"))
        want[i] = f"{a}\n\n{b}\n" if i < 12 else f"{a}\n{b}"
    rows += [(40, "share this page 1\n" + words(r, 9), "s", 0, "x"), (41, f"share this page 1\n{words(r, 12)}", "t", 0, "x"), (42, None, "s", 0, "x"), (0, rows[0][1], "s", 0, "x")]
    want[41] = rows[31][1]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, key string")
    out = quality_rules.clean_lines(docs)
    got = out.collect()
    assert out.columns == docs.columns and sorted((x.doc_id, x.text) for x in got) == sorted([*want.items(), (0, want[0])])
    assert all(x.n_chars == len(x.text) and x.key == "x" for x in got)
    judged = {x.doc_id: x for x in quality_rules.judge_lines(docs).collect()}
    assert {i for i, x in judged.items() if x.kept} == set(want)
    assert all(judged[i].n_words - judged[i].removed_words == len(t.split()) for i, t in want.items())
    kept = quality_rules.judge_lines(odd).filter("kept").count()
    assert quality_rules.clean_lines(odd).columns == odd.columns and quality_rules.clean_lines(odd).count() == kept


def test_the_limit_on_a_source_of_over_a_thousand_texts(spark):
    r = random.Random(17)
    lines = lambda i: [words(r, 20), *(["line in sixteen"] if i < 16 else []), *(["line in fifteen"] if i < 15 else [])]
    docs = spark.createDataFrame([(i, "\n".join(lines(i)), "s") for i in range(1500)], "doc_id long, text string, source string")
    got = {x.doc_id: x.text for x in quality_rules.clean_lines(docs).collect()}
    assert len(got) == 1500 and not any("sixteen" in t for t in got.values()) and sum("fifteen" in t for t in got.values()) == 15


def test_url_rules(spark):
    pages = spark.createDataFrame([(1, None), (2, "no scheme"), (3, "http://A.Example.COM/en/x?q"), (4, "http://www.example.com/en/"), (5, "x://y.net/es/1"), (5, "x://y.net/es/1"), (None, "http://example.com")], "page_id long, url string").withColumn("host", F.lit(1)).withColumn("path", F.lit(2))
    got = [(r.page_id, r.rule, r.verdict) for r in url_filter.judge_urls(pages, url_filter.rules_table(spark)).collect()]
    assert sorted(got, key=str) == sorted([(1, None, "allow"), (2, None, "allow"), (3, "example.com/en/", "block"), (4, "www.example.com/en/", "allow"), (5, "net/es/", "block"), (5, "net/es/", "block"), (None, None, "allow")], key=str)
    many = spark.range(3000).select(F.lit("block").alias("verdict"), F.concat(F.lit("h"), "id", F.lit(".org")).alias("host"), F.lit("/").alias("path"))
    hits = spark.range(6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.h"), "id", F.lit(".org/")).alias("url"))
    assert url_filter.judge_urls(hits, many).filter("verdict = 'block'").count() == 3000
    assert url_filter.judge_urls(hits, many.filter("false")).filter("verdict = 'block'").count() == 0


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary())
    want = {r.doc_id: np.array(t.encode(r.text, add_special_tokens=False).ids + [0], "<u4") for r in docs.collect()}
    pieces = packing.pack(docs, tokens.vocabulary()).collect()
    for p in pieces:
        assert zlib.crc32(want[p.doc_id][p.start : p.start + p.length].tobytes()) == p.ids_crc32 and p.doc_tokens == len(want[p.doc_id])
    assert sum(p.length for p in pieces) == sum(map(len, want.values()))
    by = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert by.get(p.sequence_id, 0) == p.offset
        by[p.sequence_id] = p.offset + p.length
    assert all(n == 1024 or n & (n - 1) == 0 for n in by.values())


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    r = random.Random(2)
    own, t = tokens.Encoder(tokens.vocabulary()), Tokenizer.from_file(tokens.vocabulary())
    for _ in range(2000):
        text = "".join(r.choice([" ", "\n", "a", "the", "é", "\r", "\x85", "\u2028", "日本", "\U0001f600", ".", "'s", "12", "\u00a0", "<|endoftext|>", "  ", "\t", "\u3000", "\x1c", "ß!"]) for _ in range(r.randint(0, 12)))
        assert np.frombuffer(own.ids(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_separator_scan_over_tiny_blocks(spark):
    r = random.Random(3)
    ids = [r.choice([7, 9, 11, 11]) for _ in range(500)]
    rows = [("f", i // 8, np.array(ids[i : i + 8], "<u4").tobytes()) for i in range(0, 500, 8)]
    got = separators.separator_scan(spark.createDataFrame(rows, separators.BLOCKS).repartition(4), end=9).collect()
    ends = [-1, *(i for i, x in enumerate(ids) if x == 9)]
    want = [(k, a + 1, b - a - 1, True) for k, (a, b) in enumerate(zip(ends, ends[1:]))]
    if ends[-1] < 499:
        want.append((len(ends) - 1, ends[-1] + 1, 499 - ends[-1], False))
    assert sorted((x.ordinal, x.start, x.n_tokens, x.ended) for x in got) == want


def test_fingerprints_are_multisets():
    of = lambda t: fingerprints.text_of(*(v[0] for v in fingerprints.vectors(fingerprints.pa.array([t]))))
    assert of("a b c d\nx y z\n\nq") == of("q\n\nx y z\na b c d") != of("q\nx y z\na b c d")
    assert fingerprints.insert(of("q\nx y"), "new one here") == of("new one here\nx y\nq")
    assert fingerprints.insert(of("q\n\nx y"), "") != of("q\n\nx y") and fingerprints.insert(of("q\n\nx y"), "", -1) == of("x y\nq")


def test_likeness_of_a_line_repeated_often():
    line = "one two three four five six seven\n"
    for many in (10_000, 70_000):
        a, b = ([v[[k]] for v in fingerprints.vectors(fingerprints.pa.array([line * many, line * (many // 2)]))] for k in (0, 1))
        assert fingerprints.likeness(a, b)[0] > 0.999
        x, y = fingerprints.parse(fingerprints.insert(fingerprints.text_of(*(v[0] for v in b)), line[:-1], many - many // 2))
        assert (x == a[0][0]).all() and (y == a[1][0]).all()


def test_near_groups_against_brute_force(spark):
    r = random.Random(5)
    texts = []
    for _ in range(12):
        base = words(r, r.randint(4, 120)).split()
        for _ in range(r.randint(1, 30)):
            texts.append(" ".join(w if r.random() > 0.03 else "new" for w in base))
    docs = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        old = root[:]
        for i, a in enumerate(sets):
            root[i] = min(root[j] for j, b in enumerate(sets) if 100 * len(a & b) >= 80 * len(a | b))
        if old == root:
            break
    got = {x.doc_id: x.component_id for x in near_dedup.near_groups(docs).collect()}
    assert got == {3 * i: 3 * k for i, k in enumerate(root)}


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n)), "".join("ba"[bin(i).count("1") % 2] for i in range(n))


def test_hashes_tell_structured_texts_apart(spark):
    """Words whose polynomial hashes modulo 2^64 are equal, whatever the base."""
    for n in (32, 64, 1024, 4096):
        one, two = thue_morse(n)
        flat = np.frombuffer((one + two).encode(), np.uint8)
        h = common.span_hashes(flat, np.array([0, n]), np.array([n, 2 * n]), lanes=2)
        assert h[0][0] != h[0][1] and h[1][0] != h[1][1]
        docs = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
        assert {x.doc_id: x.component_id for x in near_dedup.near_groups(docs).collect()} == {1: 1, 2: 2, 3: 1}
        prints = {x.doc_id: x.fingerprint for x in fingerprints.fingerprint_edits(docs).collect()}
        assert prints[1] == prints[3] != prints[2]


def test_windows_against_a_plain_loop():
    r = random.Random(21)
    words_ = np.array([r.randint(0, 5) for _ in range(300)], np.uint64)
    counts = np.array([0, 0, 3, 4, 60, 61, 200, 200, 300])
    for k in (1, 2, 3, 5, 6, 7, 8, 13):
        got, before = common.windows(words_, counts, k)
        want = []
        for a, b in zip(counts, counts[1:]):
            w = words_[a:b].tolist()
            want.append([tuple(w[i : i + k]) for i in range(len(w) - k + 1)] or ([tuple(w)] if w else []))
        assert np.diff(before).tolist() == [len(x) for x in want]
        names = {}
        for h, w in zip(got.tolist(), [x for y in want for x in y]):
            assert names.setdefault(h, w) == w
        assert len(names) == len(set(names.values()))


def test_crowded_buckets_against_brute_force(spark):
    """Documents that share a large part but are no near duplicates, near copies among them, and a large group of near copies."""
    r = random.Random(22)
    part = words(r, 150).split()
    texts = [" ".join(part + words(r, 50).split()) for _ in range(70)]
    for k in (3, 3, 9, 40, 41, 42):
        w = texts[k].split()
        w[r.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    base = words(r, 120).split()
    texts += [" ".join(w if r.random() > 0.012 else "new" for w in base) for _ in range(60)]
    r.shuffle(texts)
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    linked = [[j for j, b in enumerate(sets) if 100 * len(a & b) >= 80 * len(a | b)] for a in sets]
    root = list(range(len(texts)))
    while (new := [min(root[j] for j in linked[i]) for i in range(len(texts))]) != root:
        root = new
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x.doc_id: x.component_id for x in near_dedup.near_groups(docs).collect()} == dict(enumerate(root))
    assert len({root[i] for i, t in enumerate(texts) if t.startswith(part[0] + " ")}) >= 60


def test_block_links_against_brute_force():
    r = random.Random(23)
    for sides in (np.zeros(40, np.int8), np.array([i % 2 for i in range(40)], np.int8)):
        base = list(range(60))
        plain = [set(r.sample(base, r.randint(48, 60))) for _ in range(40)]
        lane = [np.array(sorted(s), np.uint64) for s in plain]
        pairs = {(i, j) for i in range(40) for j in range(40) if i != j and (not sides.any() or sides[i] != sides[j]) and 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j])}
        roots = np.array([i // 3 for i in range(40)])
        got = near_dedup.block_links(lane, [x * np.uint64(7) for x in lane], sides, roots, 80)

        def reach(links):
            top = list(range(14))
            for _ in range(14):
                for i, j in links:
                    top[i // 3] = top[j // 3] = min(top[i // 3], top[j // 3])
            return top

        assert set(got) <= pairs and reach(got) == reach(pairs) and len(got) == 14 - len(set(reach(pairs)))


def test_base_patterns_against_the_regular_expressions():
    r = random.Random(6)
    kinds = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    for _ in range(5000):
        text = "".join(r.choice("01259..@@++- ()ab") for _ in range(r.randint(1, 60)))
        want = []
        for k, p in enumerate(kinds):
            for m in re.finditer(p, text):
                digits = re.sub("[^0-9]", "", m[0])
                if [True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else True, 12 <= len(digits) <= 19 and pii.luhn(digits) if digits else False, 9 <= len(digits) <= 15][k]:
                    want.append((m.start(), m.end(), k))
        assert pii.base_spans(text) == sorted(want, key=lambda s: (s[0], s[2]))


def test_the_model_finds_held_out_entities():
    model = pii.SemiMarkov()
    model.weights = pii.trained()
    hit = wrong = missed = 0
    for text, spans in pii.examples(200, 99):
        found = set(model.decode(text))
        hit, wrong, missed = hit + len(found & set(spans)), wrong + len(found - set(spans)), missed + len(set(spans) - found)
    assert hit / (hit + wrong) > 0.9 and hit / (hit + missed) > 0.9


def test_islands_hold_whole_entities():
    finder = pii.Finder(pii.trained().astype(np.float32))
    for text in ["anna (at) mail (dot) org", "anna (at) mail.org", "anna [at] mail [dot] org is where", "write to anna (at) mail (dot) org", "write to anna (at) mail (dot) org or call us"]:
        start, end = text.index("anna"), text.index("org") + 3
        assert finder.spans(text) == ([], [(start, end, 0)])
    hit = wrong = missed = 0
    r = random.Random(15)
    for text, spans in pii.examples(200, 99):
        before, after = words(r, 30) + " ", " " + words(r, 30)
        for shift, t in [(0, text), (len(before), before + text + after)]:
            base, more = finder.spans(t)
            found, want = set(base + more), {(a + shift, b + shift, k) for a, b, k in spans}
            hit, wrong, missed = hit + len(found & want), wrong + len(found - want), missed + len(want - found)
            if not base:
                assert more == finder.model.decode(t)
    assert hit / (hit + wrong) > 0.95 and hit / (hit + missed) > 0.95


def test_classifier_on_held_out_rows():
    r = random.Random(7)
    grades = [r.choice([0, 1, 2, 2, 2]) for _ in range(600)]
    texts = [words(r, 40).upper().replace(" ", "!! ") if g == 0 else words(r, 40) + (" idiot" if g == 1 else "") for g in grades]
    import pyarrow as pa

    doc, bucket, _ = quality_classifier.features(pa.array(texts))
    train = doc < 400
    model = quality_classifier.OrdinalModel.fit(doc[train], bucket[train], np.array(grades[:400]))
    grade, tail = model.grades(np.bincount(doc, weights=model.weights[bucket], minlength=600))
    assert ((tail[400:] >= 0.5) == (np.array(grades[400:]) == 2)).mean() > 0.95
    assert (np.diff(model.thresholds) > 0).all() and ((grade >= 0) & (grade <= 2)).all()


def test_mix_meets_targets(spark):
    r = random.Random(8)
    docs = spark.createDataFrame([(i, words(r, r.randint(0, 90)), r.choice("aaabc")) for i in range(400)] + [(900, words(r, 64), None)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).toPandas()
    by = rows.groupby("source", dropna=False).agg({"source_size": "first", "target": "first", "taken": "sum", "size": "sum"})
    assert (by.source_size == by["size"]).all() and ((by.taken - by.target).abs() <= 3 * mixing.BLOCK).all() and (rows.taken <= 3 * rows["size"]).all()
    assert by.target.sum() == pytest.approx(by["size"].sum())
    text = mixing.mixed_documents(docs).toPandas()
    assert sum(len(t.split()) for t in text.text) == rows.taken.sum()
    assert mixing.mix(docs.repartition(3)).toPandas().sort_values("doc_id").taken.tolist() == rows.sort_values("doc_id").taken.tolist()


def test_repeated_passages(spark):
    r = random.Random(9)
    shared = words(r, 70).split()
    fuzzy = [w if k % 25 else "other" for k, w in enumerate(shared)]
    docs = [(10 + i, words(r, 100) + " " + " ".join(shared if i % 2 else fuzzy) + " " + words(r, 60)) for i in range(8)] + [(i, words(r, 300)) for i in range(8)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x.doc_id for x in got} == set(range(11, 18))
    assert all(90 < x.start_word < 110 and 160 < x.end_word < 180 and x.equal_words >= 0.8 * 66 for x in got)


def test_passages_with_other_words_between(spark):
    r = random.Random(12)
    docs, want = [], {}
    for gap in (40, 100, 200, 400):
        for inserted in (False, True):
            one, two, k = words(r, 60), words(r, 60), len(docs)
            docs.append((k, f"{words(r, 80)} {one} {words(r, 0 if inserted else gap)} {two} {words(r, 80)}"))
            docs.append((k + 1, f"{words(r, 80)} {one} {words(r, gap)} {two} {words(r, 80)}"))
            want[k + 1] = [(80, 140), (140 + gap, 200 + gap)]
    copy = words(r, 300).split()
    k = len(docs)
    docs += [(k, " ".join(copy)), (k + 1, " ".join(copy[:100] + words(r, 100).split() + copy[200:]))]
    want[k + 1] = [(0, 100), (200, 300)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    for i, spans in want.items():
        assert sorted((x.passage_start, x.passage_end) for x in got if x.doc_id == i) == spans
    assert {x.doc_id for x in got} == set(want)


def test_later_copies_of_a_passage_in_a_document(spark):
    r = random.Random(14)
    shared, refrain = words(r, 80), " ".join([words(r, 7)] * 20)
    docs = [(0, f"{words(r, 60)} {shared} {words(r, 60)}"), (1, f"{words(r, 60)} {shared} {words(r, 100)} {shared} {words(r, 500)} {shared}"), (2, f"{words(r, 60)} {refrain}"), (3, f"{words(r, 90)} {refrain} {words(r, 60)}")]
    docs.append(docs[1])
    got = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.passage_start, x.passage_end) for x in got if x.doc_id < 3) == [(1, 60, 140), (1, 240, 320), (1, 820, 900)]
    assert {(x.passage_start, x.passage_end) for x in got if x.doc_id == 3} == {(90, 230)}


def test_alike_parts_against_brute_force():
    r = random.Random(13)
    for _ in range(300):
        steps = np.array([(1, 1, 1) if (c := r.random()) < 0.75 else (1, 1, 0) if c < 0.9 else (r.randint(0, 9), r.randint(1, 9), 0) for _ in range(r.randint(20, 90))])
        alike = lambda i, j: (steps[i:j, 2].sum() >= substring_dedup.ALIKE * steps[i:j, :2].sum(axis=0) - 1e-9).all()
        n = len(steps)
        full = [bool(s.all()) for s in steps]
        lengths = [steps[i:j, 0].sum() for i in range(n) for j in range(i + 1, n + 1) if full[i] and full[j - 1] and alike(i, j)]
        got = substring_dedup.alike_parts(steps)
        assert all(alike(i, j) for i, j in got) and all(a[1] <= b[0] for a, b in zip(got, got[1:]))
        longest = n and steps[:, 0].sum() if alike(0, n) else max(lengths, default=0)
        assert max((steps[i:j, 0].sum() for i, j in got), default=0) >= (longest if longest >= substring_dedup.PART else 0)


def test_chains_are_the_best():
    r = random.Random(10)
    for _ in range(100):
        p, q = (np.array([r.randint(0, 40) for _ in range(8)]) for _ in range(2))
        best = 0.0

        def extend(i, score):
            nonlocal best
            best = max(best, score)
            for j in range(8):
                if p[j] > p[i] and q[j] > q[i]:
                    extend(j, score + substring_dedup.WORTH - substring_dedup.GAP_COST * (p[j] - p[i] + q[j] - q[i]))

        for i in range(8):
            extend(i, substring_dedup.WORTH)
        top = substring_dedup.chains(p, q)[0]
        score = sum(substring_dedup.WORTH for _ in top) - substring_dedup.GAP_COST * (p[top[-1]] - p[top[0]] + q[top[-1]] - q[top[0]])
        assert score == pytest.approx(best)


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() > 0
        if name != "packing":
            assert out.columns == docs.columns
            docs = corpus_pipeline.written(out, corpus_pipeline.work_folder(spark), name)


def test_near_duplicates_stage_against_brute_force(spark):
    import corpus_pipeline

    r = random.Random(18)
    bases = [words(r, 60).split() for _ in range(10)]
    rows = [(i * 2 + 1, " ".join(w if r.random() > 0.02 else "new" for w in bases[i % 10]), "s") for i in range(40)]
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t, _ in rows)}
    root = {i: i for i in sets}
    for _ in sets:
        root = {i: min(root[j] for j, b in sets.items() if 100 * len(a & b) >= 80 * len(a | b)) for i, a in sets.items()}
    alone = [(None, words(r, 50), "s"), (None, None, "s"), (None, "", "t"), (900, words(r, 50), "s"), (901, None, "s")]
    docs = spark.createDataFrame(rows + rows[:3] + alone * 3, "doc_id long, text string, source string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    found = [x.doc_id for x in got.collect()]
    want = [i for i in sets if root[i] == i]
    assert got.columns == docs.columns and sorted(i for i in found if i is not None and i < 900) == want
    assert found.count(900) == 1 and found.count(901) <= 1 and found.count(None) == 2


def test_personal_data_stage_against_whole_texts(spark):
    import corpus_pipeline

    model = pii.SemiMarkov()
    model.weights = pii.trained().astype(np.float32)
    texts, want = [None, "", "a@b.co, then anna (at) mail (dot) org"], [None, "", "<email>, then <email>"]
    for text, _ in pii.examples(150, 98):
        if not pii.base_spans(text):
            texts.append(text)
            for a, b, k in reversed(model.decode(text)):
                text = f"{text[:a]}<{pii.KINDS[k]}>{text[b:]}"
            want.append(text)
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    got = sorted(corpus_pipeline.personal_data(spark, docs, SF).collect())
    assert len(texts) > 50 and [x.text for x in got] == want and all(x.text is None or x.n_chars == len(x.text) for x in got)


# ---------------------------------------------------------------- brute force for what SQL can't express
def test_ordinal_gradient_by_differences():
    r = np.random.default_rng(31)
    n, used, levels = 40, 6, 4
    doc, column = np.repeat(np.arange(n), 3), r.integers(0, used, 3 * n)
    grade, each = r.integers(0, levels, n), r.random(n)
    params = r.normal(size=used + levels - 1)
    _, g = quality_classifier.penalised_loss(params, doc, column, grade, each, levels)
    for k in range(len(params)):
        step = np.zeros(len(params))
        step[k] = 1e-5
        up, down = (quality_classifier.penalised_loss(params + x, doc, column, grade, each, levels)[0] for x in (step, -step))
        assert g[k] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-5)


def test_ordinal_query_against_scoring_by_hand(spark):
    import math

    import pyarrow as pa

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit(docs, quality_classifier.graded(labels))
    weights, got = model.weights.astype(np.float32), {x.doc_id: x for x in QUERIES["op1_ordinal_quality"](spark, SF).collect()}
    assert len(got) == docs.count() and list(model.thresholds) == sorted(model.thresholds)
    for row in docs.collect():
        _, buckets, _ = quality_classifier.features(pa.array([row.text]))
        score = float(sum(float(weights[b]) for b in set(buckets.tolist())))
        above = [1 - 1 / (1 + math.exp(-(t - score))) for t in model.thresholds]
        x = got[row.doc_id]
        assert x.expected_grade == pytest.approx(sum(above), abs=1e-4) and x.tail_probability == pytest.approx(above[quality_classifier.GRADE - 1], abs=1e-4)
        assert x.kept == (x.tail_probability >= quality_classifier.CHANCE)


def test_repeated_labelled_documents_train_once(spark):
    docs = spark.createDataFrame([(i % 5, f"text {i}") for i in range(40)] + [(None, "x")], "doc_id long, text string")
    seen = []
    keep, quality_classifier.OrdinalModel.fit = quality_classifier.OrdinalModel.fit, classmethod(lambda cls, doc, bucket, grade: seen.append(len(grade)))
    try:
        quality_classifier.fit(docs, spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, grade int"))
    finally:
        quality_classifier.OrdinalModel.fit = keep
    assert seen == [5]


def test_segmentation_against_enumeration():
    """The decoded entities are those of the best of all segmentations, tried one by one."""
    r, model = random.Random(33), pii.SemiMarkov()
    weights = np.random.default_rng(33).normal(size=model.weights.shape)
    model.weights = weights - 0.8
    for _ in range(60):
        text = "".join(r.choice(["1", "23", "a", " ", "@", ".", "-", "(", "at"]) for _ in range(r.randint(1, 8)))
        tokens_, edges = pii.tokens_of(text)
        starts, ends, found = model.segments(tokens_, "")
        score = {(int(i), int(j)): s for i, j, s in zip(starts, ends, model.scores(found).T)} if len(starts) else {}

        def best(i):
            if i >= len(tokens_):
                return 0.0, []
            top = best(i + 1)
            for j in range(i + 1, len(tokens_) + 1):
                for k, s in enumerate(score.get((i, j), [])):
                    rest = best(j)
                    if s + rest[0] > top[0] + 1e-9:
                        top = (s + rest[0], [(edges[i], edges[j], k), *rest[1]])
            return top

        total, spans = best(0)
        got = model.decode(text)
        at = {e: n for n, e in enumerate(edges)}
        assert sum(score[at[a], at[b]][k] for a, b, k in got) == pytest.approx(total) and len(got) == len(spans)


def test_decoding_in_steps_is_decoding_at_once(monkeypatch):
    model = pii.SemiMarkov()
    model.weights = pii.trained()
    texts = [t for t, _ in pii.examples(120, 77)]
    whole = [model.decode(t) for t in texts]
    monkeypatch.setattr(pii, "STEP", 7)
    assert [model.decode(t) for t in texts] == whole and any(whole)


def test_personal_data_query_against_whole_texts(spark):
    import hashlib

    finder = pii.Finder(pii.trained().astype(np.float32))
    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for x in QUERIES["op2_semi_markov_pii"](spark, SF).collect():
        base, text = pii.base_spans(texts[x.doc_id]), texts[x.doc_id]
        assert x.base_sha256 == hashlib.sha256(pii.listed(base).encode()).hexdigest() and [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(k == n for _, _, k in base) for n in range(4)]
        spans = [(p.split(":")[0], *map(int, p.split(":")[1:])) for p in x.spans.split(",") if p]
        assert {(pii.KINDS[k], a, b) for a, b, k in base} <= set(spans) and len(spans) == len(base) + x.n_added
        if not base:  # the whole text, decoded at once
            assert [(pii.KINDS[k], a, b) for a, b, k in finder.model.decode(text)] == spans


def test_many_spans_cost_in_proportion():
    import time

    finder = pii.Finder(pii.trained().astype(np.float32))
    took = []
    for n in (1000, 8000):
        text = " ".join(f"ab{i}@cd.org wrote to anna (at) mail (dot) org then" for i in range(n))
        began = time.time()
        base, more = finder.spans(text)
        took.append(time.time() - began)
        assert len(base) == n and len(more) == n
    assert took[1] < 24 * took[0] + 1


def test_token_counts_query_against_the_tokenizer(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary())
    t.encode_special_tokens = True
    want = {x.doc_id: len(t.encode(x.text, add_special_tokens=False).ids) for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {x.doc_id: x.n_tokens for x in QUERIES["op3_separator_scan"](spark, SF).collect()} == want


def test_raw_token_files_and_repeated_blocks(spark, tmp_path):
    r = random.Random(34)
    want = []
    for name in ("a.bin", "b.bin", "empty.bin"):
        ids = [r.choice([5, 6, 9]) for _ in range(0 if name == "empty.bin" else 1000)]
        (tmp_path / name).write_bytes(np.array(ids, "<u4").tobytes() + (b"xy" if name == "b.bin" else b""))
        ends = [-1, *(i for i, x in enumerate(ids) if x == 9)]
        want += [(name, k, a + 1, b - a - 1, True) for k, (a, b) in enumerate(zip(ends, ends[1:]))]
        if ends[-1] < len(ids) - 1:
            want.append((name, len(ends) - 1, ends[-1] + 1, len(ids) - 1 - ends[-1], False))
    blocks = separators.read_blocks(spark, f"file://{tmp_path}/*.bin", block=16, part=300)
    found = lambda df: sorted((x.file.rsplit("/", 1)[1], x.ordinal, x.start, x.n_tokens, x.ended) for x in df.collect())
    assert found(separators.separator_scan(blocks, end=9)) == sorted(want)
    assert found(separators.separator_scan(blocks.unionByName(blocks.filter("block % 3 = 0")), end=9)) == sorted(want)


def test_edited_texts_against_plain_python(spark):
    import hashlib

    rows = sorted((x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {x.doc_id: x for x in QUERIES["op5_multiset_hash"](spark, SF).collect()}
    prints = {}
    for (i, text), (j, after) in zip(rows, rows[1:] + rows[:1]):
        n, x = len(text), got[i]
        edited = text[: n - n // 2] + after[: n // 2]
        assert x.n_chars == n and x.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        one = fingerprints.vectors(fingerprints.pa.array([text, edited]))
        assert [x.fingerprint, x.edited_fingerprint] == [fingerprints.text_of(one[0][k], one[1][k]) for k in (0, 1)]
        pairs = [tuple(v[None, :] for v in fingerprints.parse(f)) for f in (x.fingerprint, x.edited_fingerprint, got[j].fingerprint)]
        assert [x.near_edited, x.near_next] == [fingerprints.likeness(pairs[0], p)[0] for p in pairs[1:]] and 0 <= x.near_next <= 1
        assert prints.setdefault(x.fingerprint, sorted(text.split("\n"))) == sorted(text.split("\n"))


def test_output_shards_of_the_mix(spark):
    r = random.Random(35)
    rows = [(i, words(r, r.randint(0, 120)), r.choice("aaaabbc")) for i in range(300)] + [(900, words(r, 64), None), (901, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    text = {i: (t or "").split() for i, t, _ in rows}
    taken = {x.doc_id: x.taken for x in mixing.mix(docs, block=8, shard=64).collect()}
    got = mixing.mixed_shards(docs, block=8, shard=64).collect()
    sums, places = dict.fromkeys(taken, 0), {}
    for x in got:
        w = x.text.split()
        assert w == text[x.doc_id][x.low : x.low + len(w)] and 0 < len(w) <= 8
        sums[x.doc_id] += len(w)
        places.setdefault(x.shard, {}).setdefault(x.place, set()).add((x.source, x["pass"], x.block))
    assert sums == taken
    assert all(sorted(p) == list(range(len(p))) and len(p) <= 64 and all(len(s) == 1 for s in p.values()) for p in places.values())
    slots = [s for p in places.values() for x in p.values() for s in x]
    assert len(slots) == len(set(slots))  # no pass takes a block twice
    counts = np.array([[sum(next(iter(s))[0] == c for s in p.values()) for c in "abc"] for k, p in sorted(places.items())][:-1])
    assert (counts.max(axis=0) - counts.min(axis=0) <= 3).all() and (counts.max(axis=0) > counts.min(axis=0)).any()  # drawn, near the mean


def test_many_small_sources_meet_the_total(spark):
    r = random.Random(36)
    docs = spark.createDataFrame([(i, words(r, 10), f"s{i:03}") for i in range(300)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    assert abs(sum(x.taken for x in rows) - 3000) <= 30 and all(x.taken <= 30 for x in rows)
    by = {w: sum(x.taken for i, x in enumerate(sorted(rows)) if i % 3 == w) for w in range(3)}
    assert all(abs(by[w] - 500 * (w + 1)) < 260 for w in by)


def test_longest_common_subsequence_against_a_table():
    r = random.Random(37)
    for _ in range(200):
        x, y = ([r.randint(0, 6) for _ in range(r.randint(0, 90))] for _ in range(2))
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
        assert substring_dedup.equal_in_gap(np.array(x), np.array(y)) == table[-1][-1]


def fuzzy_pairs(r, n, length, rate):
    """Documents 2k and 2k + 1 share a passage of which each word is replaced, dropped or followed by another with probability `rate`."""
    docs, want = [], {}
    for k in range(n):
        p = words(r, length).split()
        q = []
        for w in p:
            c = r.random()
            q += [words(r, 1)] if c < rate * 0.6 else [w, words(r, 1)] if c < rate * 0.8 else [] if c < rate else [w]
        low = r.randint(30, 150)
        docs.append((2 * k, f"{words(r, r.randint(30, 150))} {' '.join(p)} {words(r, 40)}"))
        docs.append((2 * k + 1, f"{words(r, low)} {' '.join(q)} {words(r, 40)}"))
        want[2 * k + 1] = (low, low + len(q))
    return docs, want


def test_fuzzy_passages_against_a_whole_aligner(spark):
    """Recall of at least 0.9 against local alignment of the whole texts (match 1, mismatch and gap -2)."""
    r = random.Random(38)
    docs, want = fuzzy_pairs(r, 40, 120, 1 / 12)
    texts = {i: t.split() for i, t in docs}

    def local(x, y):
        best, low, row, first = 0, None, [0] * (len(y) + 1), [0] * (len(y) + 1)
        for i, a in enumerate(x):
            new, begin = [0], [i + 1]
            for j, b in enumerate(y):
                s, f = max((row[j] + (1 if a == b else -2), first[j] if row[j] else i), (row[j + 1] - 2, first[j + 1]), (new[j] - 2, begin[j]))
                new.append(max(0, s))
                begin.append(f if s > 0 else i + 1)
                if s > best:
                    best, low = s, (f, i + 1)
            row, first = new, begin
        return low

    got = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    seen = found = 0
    for i in want:
        span = local(texts[i], texts[i - 1])
        if span and span[1] - span[0] >= substring_dedup.PASSAGE:
            seen += 1
            found += any(x.doc_id == i and min(x.passage_end, span[1]) - max(x.passage_start, span[0]) >= 0.8 * (span[1] - span[0]) for x in got)
    assert seen >= 35 and found >= 0.9 * seen and {x.doc_id for x in got} <= set(want)


def test_alignment_goes_on_beyond_what_it_sees_first(spark):
    """A passage of which every thirteenth word differs shares seeds in its first words only."""
    r = random.Random(39)
    p = words(r, 900).split()
    q = [w if k < 30 or k % 7 else words(r, 1) for k, w in enumerate(p)]
    docs = [(0, f"{words(r, 60)} {' '.join(p)} {words(r, 60)}"), (1, f"{words(r, 60)} {' '.join(q)} {words(r, 60)}")]
    got = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [(x.doc_id, x.passage_start, x.passage_end) for x in got] == [(1, 60, 960)]


def test_rows_that_repeat_an_id_with_other_texts(spark):
    r = random.Random(40)
    shared = [words(r, 70) for _ in range(4)]
    docs = [(k, f"{words(r, 60)} {s} {words(r, 60)}") for k, s in enumerate(shared)] + [(9, f"{words(r, 60)} {s} {words(r, 60)}") for s in shared]
    got = substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").withColumn("version", F.lit(1))).collect()
    assert sorted((x.doc_id, x.partner_id, x.passage_start, x.passage_end) for x in got) == [(9, k, 60, 130) for k in range(4)]


def test_repeats_within_a_document(spark):
    r = random.Random(41)
    s = words(r, 70)
    docs = spark.createDataFrame([(1, f"{words(r, 60)} {s} {words(r, 200)} {s} {words(r, 10)}"), (2, words(r, 200))], "doc_id long, text string")
    assert substring_dedup.repeated_passages(docs).count() == 0
    assert [(x.doc_id, x.partner_id, x.passage_start, x.passage_end, x.partner_start) for x in substring_dedup.repeated_passages(docs, within=True).collect()] == [(1, 1, 330, 400, 60)]


def test_url_filter_that_stays_distributed(spark):
    many = spark.range(3000).select(F.lit("block").alias("verdict"), F.concat(F.lit("h"), "id", F.lit(".org")).alias("host"), F.lit("/").alias("path"))
    hits = spark.range(6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.h"), "id", F.lit(".org/")).alias("url"))
    hits = hits.unionByName(spark.createDataFrame([(None, None), (7, "x"), (7, "x")], "page_id long, url string"))
    one, two = (sorted(map(tuple, url_filter.judge_urls(hits, many, most=most).collect()), key=str) for most in (0, 1 << 20))
    assert one == two and sum(x[-1] == "block" for x in one) == 3000 and len(one) == 6003
    count = many.count()
    hashed = spark.range(20000).select(F.xxhash64("id").alias("k"))
    assert url_filter.passing(hashed, many.select(F.xxhash64("host", "path").alias("k")), count, most=0).count() < 200
    assert url_filter.judge_urls(hits.filter("false"), many, most=0).count() == 0


# ---------------------------------------------------------------- the pipeline
@pytest.fixture(scope="module")
def clashing(spark, odd):
    """Odd rows with columns that have the names that stages use inside."""
    names = ["_doc_id", "_gone", "_kept", "_judged", "_again", "_row", "id_", "row_", "doc", "x", "cuts", "n", "w", "clean", "tail", "grade", "_wanted", "component_id", "version", "start", "rank"]
    return odd.select("doc_id", "text", "lang", "source", "n_chars", *(F.lit(k).alias(c) for k, c in enumerate(names)))


def test_stages_on_odd_rows_and_clashing_names(spark, clashing, tmp_path):
    import corpus_pipeline

    for t in ("labels",):
        spark.createDataFrame([(i, 1, 0) for i in (4, 5, 6)] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{t}.parquet")
    for docs in (clashing, clashing.filter("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            rows = out.collect()
            if name != "packing":
                assert out.columns == docs.columns
            if docs.isEmpty():
                assert not rows
            elif name in ("quality_classifier", "near_dedup", "pii"):
                assert all(x._gone == 1 and x.rank == 20 for x in rows)
                assert len(rows) == {"quality_classifier": 6, "near_dedup": 8, "pii": 10}[name]
            elif name == "mixing":
                assert {x.doc_id for x in rows} <= {4, 5, 6, 7, None} and all(x.text and x.n_chars == len(x.text) for x in rows)


def test_pipeline_against_its_stages(spark):
    """Each stage's rows against plain Python on what the stage before has kept, and run() against the stages one by one."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = {x.doc_id: x.text for x in docs.collect()}
    judged = {x.doc_id: x.kept for x in quality_classifier.classify(docs, labels).collect()}
    folder = corpus_pipeline.work_folder(spark)
    kept = [corpus_pipeline.written(corpus_pipeline.STAGES[0][1](spark, docs, SF), folder, "t0")]
    assert {x.doc_id: x.text for x in kept[0].collect()} == {i: t for i, t in texts.items() if judged[i]}
    kept.append(corpus_pipeline.written(corpus_pipeline.STAGES[1][1](spark, kept[0], SF), folder, "t1"))
    sets = {x.doc_id: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for x in kept[0].collect() for w in [re.split(r"[ \t-\r]+", x.text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).strip(" \t\n\x0b\x0c\r"))]}
    root = {i: i for i in sets}
    linked = {i: [j for j, b in sets.items() if 100 * len(a & b) >= 80 * len(a | b)] for i, a in sets.items()}
    while (new := {i: min(root[j] for j in linked[i]) for i in sets}) != root:
        root = new
    assert {x.doc_id for x in kept[1].collect()} == {i for i in sets if root[i] == i}
    kept.append(corpus_pipeline.written(corpus_pipeline.STAGES[2][1](spark, kept[1], SF), folder, "t2"))
    assert {x.doc_id for x in kept[2].collect()} == {x.doc_id for x in kept[1].collect()} and not any(list(pii.emails(x.text)) for x in kept[2].collect())
    kept.append(corpus_pipeline.written(corpus_pipeline.STAGES[3][1](spark, kept[2], SF), folder, "t3"))
    taken, whole = {x.doc_id: x.taken for x in mixing.mix(kept[2]).collect()}, {x.doc_id: x.text.split() for x in kept[2].collect()}
    sums = dict.fromkeys(taken, 0)
    for x in kept[3].collect():
        sums[x.doc_id] += len(x.text.split())
        rest = iter(whole[x.doc_id])
        assert all(w in rest for w in x.text.split())  # words of the document, in order
    assert sums == taken
    ids = tokens.Encoder(tokens.vocabulary())
    want = sorted((x.doc_id, len(ids.ids(x.text)) // 4 + 1) for x in kept[3].collect())
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert sum(x.length for x in pieces) == sum(n for _, n in want) and sorted((x.doc_id, x.doc_tokens) for x in pieces if x.start == 0) == want


def test_batches_are_bounded_unless_the_session_says_otherwise(spark):
    import pyarrow as pa

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(0, 200, 1, 1).select(F.expr("repeat('abcdefgh', 16384)").alias("text"))
    sizes = lambda df: [r.size for r in df.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"size": [b.nbytes]}) for b in batches), "size long").collect()]
    own = name in spark.conf.getAll and spark.conf.get(name)
    try:
        spark.conf.unset(name)
        found = sizes(common.bounded(texts))
        assert sum(found) >= 200 << 17 and max(found) <= common.BATCH + (1 << 18)
        spark.conf.set(name, str(1 << 30))
        assert len(sizes(common.bounded(texts))) == 1
    finally:
        spark.conf.unset(name)
        if own:
            spark.conf.set(name, own)
