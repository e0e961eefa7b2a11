import datetime
import random
from decimal import Decimal

from tillweave.operators import portals, preambles


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, portal string, text string")


def test_field_forms(spark):
    dates = ["due 12-03-2024 x", "12/03/2024", "on 12.03.2024.", "2024-03-12T", "12 Mar 2024", "Mar 12, 2024", "12-Mar-24", "none", "99-99-2024"]
    money = ["Rs. 4,50,00,000/-", "Rs. 450.00 lakh", "INR 4.500 Cr", "45000000", "RUPEES 4,50,00,000 ONLY", "12 only"]
    rows = [(i, "d", t) for i, t in enumerate(dates)] + [(100 + i, "m", t) for i, t in enumerate(money)]
    got = {r.doc_id: r for r in portals.parsed_fields(texts(spark, rows)).collect()}
    day = datetime.date(2024, 3, 12)
    assert [got[i].date for i in range(9)] == [day, day, day, None, day, day, day, None, None]
    assert [got[100 + i].amount for i in range(6)] == [Decimal(45000000)] * 5 + [None]
    coverage = {r.portal: r for r in portals.parse_coverage(portals.parsed_fields(texts(spark, rows))).collect()}
    assert (coverage["d"].date_texts, coverage["d"].dates, coverage["m"].amounts) == (7, 6, 5)


def test_references(spark):
    known = ["NPAS-2024-0001234", "SPC/2024-25/004512", "PWD/2024/00871", "00048213", "ref-2024-00912", "MC/2025/W/00311", "TN-000412/2024"]
    rows = [(i, "p", f"No. {k} of today") for i, k in enumerate(known)]
    got = {r.doc_id: r.reference for r in portals.parsed_fields(texts(spark, rows)).collect()}
    assert [got[i] for i in range(7)] == known


def test_common_lines_are_dropped_per_portal(spark):
    rows = [(i, "p1", f"PREAMBLE\n  own {i} \n\nFOOTER") for i in range(4)] + [(9, "p2", "PREAMBLE\nx"), (10, "p2", "y"), (11, "p2", None)]
    got = {r.doc_id: (r.filtered, r.removed) for r in portals.boilerplate_filter(texts(spark, rows), 0.5).collect()}
    assert got == {**{i: (f"own {i}", 2) for i in range(4)}, 9: ("PREAMBLE\nx", 0), 10: ("y", 0), 11: ("", 0)}


def test_small_portals_keep_their_texts(spark):
    one, five = [(1, "one", "a\nb")], [(10 + i, "five", f"shared\nown {i}" if i < 2 else f"own {i}") for i in range(5)]
    reposts = [(20 + i, "posts", "same\ntext") for i in range(10)]
    only = [(40 + i, "only", "PREAMBLE" if i < 3 else f"PREAMBLE\nown {i}") for i in range(10)]
    got = {r.doc_id: (r.filtered, r.removed) for r in portals.boilerplate_filter(texts(spark, one + five + reposts + only), 0.1).collect()}
    assert all(got[i] == (t, 0) for i, _, t in one + five + reposts)
    assert all(got[40 + i] == (("PREAMBLE", 0) if i < 3 else (f"own {i}", 1)) for i in range(10))


def test_corrigenda(spark):
    docs = texts(spark, [(1, "p", "Corrigendum to road work\nbody"), (2, "p", "Road work\nbody\nCORRIGENDUM new date"), (3, "p", "Road work\nbody"), (4, "p", None)])
    flags = portals.corrigendum_flag(docs)
    assert {r.doc_id: (r.in_title, r.in_body) for r in flags.collect()} == {1: (True, True), 2: (False, True), 3: (False, False), 4: (False, False)}


def test_corrections_point_to_the_nearest_earlier_original(spark):
    rows = [  # doc, portal, published, reference, flag
        (1, "p", 1, "A", False), (2, "p", 2, "A", False), (3, "p", 3, "A", True), (4, "p", 4, "A", True), (5, "q", 5, "A", True),
        (6, "p", 6, None, False), (7, "p", 7, None, True), (8, "p", 8, "B", True), (9, "p", 9, "B", False), (10, "q", 2, "C", False),
        (11, "q", 10, "C", True),
    ]
    notices = spark.createDataFrame(rows, "doc_id bigint, portal string, published_at int, reference string, flag boolean")
    matches = spark.createDataFrame([(6, 7, 0.9), (1, 7, 0.9), (7, 9, 0.9), (3, 4, 0.9), (2, 3, 0.9), (6, 11, 0.9), (8, 9, 0.9)],
                                    "id_a bigint, id_b bigint, jaccard double")
    got = {(r.correction, r.original, r.by_reference, r.by_match) for r in portals.corrigendum_links(matches, notices).collect()}
    assert got == {(3, 2, True, True), (4, 2, True, False), (7, 6, False, True), (11, 6, False, True)}


def test_preamble_inside_run_on_text(spark):
    """1,400 characters without a line break, the same on every notice of a portal; ends and short beginnings too."""
    preamble = " ".join(f"clause{i} applies here" for i in range(70))
    footer = " ".join(f"remark{i}" for i in range(20))
    assert len(preamble) >= 1400
    rows = [(i, "agg", f"{preamble}  own{i} tender\tfor road {i} {footer}") for i in range(12)]
    rows += [(100 + i, "agg", preamble) for i in range(2)] + [(102, "agg", f"{preamble} {footer}"), (103, "agg", None), (104, "agg", "short")]
    rows += [(200 + i, "plain", f"the same few words and then something {i}") for i in range(9)]
    rows += [(300 + i, "posts", preamble + " one text") for i in range(9)]
    got = {r.doc_id: r for r in preambles.preamble_filter(texts(spark, rows), 0.5).collect()}
    assert len(got) == len(rows)
    for i in range(12):
        assert got[i].filtered == f"own{i} tender for road {i}" and (got[i].head_words, got[i].tail_words) == (210, 20)
    assert got[102].filtered == footer and got[100].filtered.split() == ["here"] and got[103].filtered == "" and got[104].filtered == "short"
    for i, _, text in rows:
        if i >= 200:
            assert got[i].filtered == text and got[i].head_words == 0


def test_common_lengths_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(preambles, "LEAST_WORDS", 2)
    draw = random.Random(6)
    stems = [[draw.choice("abc") for _ in range(40)] for _ in range(3)]
    bodies = [draw.choice(stems)[: draw.randrange(1, 40)] + [draw.choice("abcdefg") for _ in range(draw.randrange(0, 6))]
              + draw.choice(stems)[40 - draw.randrange(0, 30):] for _ in range(60)]
    rows = [(i, draw.choice("pq"), " ".join(words)) for i, words in enumerate(bodies)]
    for backwards in (False, True):
        turned = {i: (p, tuple(t.split()[::-1] if backwards else t.split())) for i, p, t in rows}
        want = {}
        for i, (portal, words) in turned.items():
            contents = {w for p, w in turned.values() if p == portal}
            for k in range(2, len(words)):
                if sum(w[:k] == words[:k] for w in contents) >= max(3, 0.2 * len(contents)):
                    want[i] = k
        found = preambles.common_lengths(texts(spark, rows), 0.2, 3, backwards).collect()
        assert {r.doc_id: r.words for r in found} == want and want


def test_cut_lengths_are_found_wherever_they_are(spark):
    draw = random.Random(2)
    rows = [(i, "p", "A" * draw.randrange(200, 4000)) for i in range(150)] + [(200 + i, "p", "b" * 1733) for i in range(9)]
    rows += [(300 + i, "q", "c" * 60) for i in range(4)] + [(400 + i, "q", "d" * (58 + i % 5)) for i in range(40)] + [(500, "r", None), (501, "r", "x")]
    docs = texts(spark, rows)
    assert {(r.portal, r.length, r.docs) for r in portals.length_spikes(docs).collect()} == {("p", 1733, 9 + sum(len(t) == 1733 for _, _, t in rows[:150]))}
    got = {r.portal: r for r in portals.portal_profile(docs).collect()}
    assert (got["p"].cut_length, got["p"].mode_length, got["q"].cut_length, got["r"].docs) == (1733, 1733, None, 2)
    assert got["p"].upper_share == round(150 / 159, 6)
    top = portals.portal_volume(docs, 1).collect()
    assert [(r.portal, r.docs) for r in top] == [("p", 159)]
