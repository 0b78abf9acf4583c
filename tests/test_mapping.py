import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from readloom.operators import align, mapping

TURN = str.maketrans("ACGT", "TGCA")


def turned(s):
    return s.translate(TURN)[::-1]


def plain_affine(read, window, band, sc):
    """Score, first base, place in the window and CIGAR, cell by cell over three states, with the same preferences."""
    size, none = len(read), -(10**9)
    state = {}  # (i, d) -> scores of M, I, D and where each came from
    best = (none, 0, 0)
    for i in range(size):
        for d in range(2 * band + 1):
            before = state.get((i - 1, d), ((none,) * 3, None))[0]
            start = 0 if i == 0 else -sc.clip
            options = [(before[0], 1), (before[1], 2), (before[2], 3)]
            from_, way = options[0]
            for x, w in options[1:]:
                if x > from_:
                    from_, way = x, w
            if from_ < start:
                from_, way = start, 0
            c = window[i + d]
            m = none if c == "\0" else from_ + (sc.match if c == read[i] != "N" else -sc.mismatch)
            up = state.get((i - 1, d + 1), ((none,) * 3, None))[0]
            left = state.get((i, d - 1), ((none,) * 3, None))[0]
            ins = max(up[0] - sc.gap_open - sc.gap_extend, up[1] - sc.gap_extend)
            dele = max(left[0] - sc.gap_open - sc.gap_extend, left[2] - sc.gap_extend)
            state[i, d] = (m, ins, dele), (way, up[1] - sc.gap_extend > up[0] - sc.gap_open - sc.gap_extend, left[2] - sc.gap_extend > left[0] - sc.gap_open - sc.gap_extend)
        row = [state[i, d][0][0] for d in range(2 * band + 1)]
        end = max(row) - (0 if i == size - 1 else sc.clip)
        if end >= best[0]:
            best = (end, i, row.index(max(row)))
    score, i, d = best
    last, ops, now = i, [], 0
    while True:
        way = state[i, d][1]
        ops.append("MID"[now])
        if now == 0:
            if way[0] == 0:
                break
            now, i = way[0] - 1, i - 1
        elif now == 1:
            now, i, d = (1 if way[1] else 0), i - 1, d + 1
        else:
            now, d = (2 if way[2] else 0), d - 1
    text = "".join(f"{len(m.group())}{m.group()[0]}" for m in re.finditer(r"M+|I+|D+", "".join(ops[::-1])))
    return score, i, i + d, (f"{i}S" if i else "") + text + (f"{size - 1 - last}S" if last < size - 1 else "")


def points(read, window, place, cigar, sc):
    """The score of an alignment, by its CIGAR."""
    out, at = 0, 0
    for n, op in re.findall(r"(\d+)([MIDS])", cigar):
        n = int(n)
        if op == "M":
            out += sum(sc.match if a == b != "N" else -sc.mismatch for a, b in zip(read[at : at + n], window[place : place + n], strict=True))
        out -= sc.clip if op == "S" else sc.gap_open + n * sc.gap_extend if op in "ID" else 0
        at += n if op in "MIS" else 0
        place += n if op in "MD" else 0
    assert at == len(read)
    return out


@pytest.mark.parametrize("sc", [mapping.Scoring(), mapping.Scoring(2, 3, 1, 1, 2), mapping.Scoring(1, 1, 2, 0, 0)])
def test_affine_equals_all_cells(sc):
    r, band, size = random.Random(4), 5, 40
    reads, windows = [], []
    for k in range(150):
        window = r.choices("ACGT" if k % 3 else "AC", k=size + 2 * band)
        s = window[band : band + size + 8]
        for _ in range(r.randint(0, 3)):
            at, n = r.randrange(len(s) - 6), r.randint(1, 4)
            kind = r.choice("IDMN")
            s[at : at + (n if kind == "D" else 0 if kind == "I" else 1)] = [] if kind == "D" else r.choices("ACGT", k=n) if kind == "I" else ["N" if kind == "N" else r.choice("ACGT")]
        s = (s + r.choices("ACGT", k=size))[:size]
        if k % 5 == 0:
            s[: r.randint(1, 15)] = r.choices("ACGT", k=r.randint(1, 15))
            s = (s + r.choices("ACGT", k=size))[:size]
        if k % 7 == 0:
            window[: band + 4] = "\0" * (band + 4)
        if k % 11 == 0:
            window[-band - 6 :] = "\0" * (band + 6)
        reads.append("".join(s))
        windows.append("".join(window))
    to = lambda rows: np.array([list(x.encode()) for x in rows], np.uint8)
    found = mapping.affine(to(reads), to(windows), band, sc)
    for k, cigar in enumerate(mapping.cigars(found, size)):
        want = plain_affine(reads[k], windows[k], band, sc)
        assert (found.score[k], found.first[k], found.place[k], cigar) == want
        assert points(reads[k], windows[k], found.place[k], cigar, sc) == want[0]


def plain_minimizers(s, k, w):
    def value(x):
        return int(x.translate(str.maketrans("ACGT", "0123")), 4)

    h = []
    for i in range(len(s) - k + 1):
        x = s[i : i + k]
        h.append(None if set(x) - set("ACGT") else int(mapping._hashed(np.array([min(value(x), value(turned(x)))], np.uint64))[0]))
    found = set()
    for i in range(len(h) - w + 1):
        part = h[i : i + w]
        if None not in part:
            found |= {(i + j, x) for j, x in enumerate(part) if x == min(part)}
    return found


def test_minimizers():
    r = random.Random(2)
    for k, w in ((5, 4), (15, 10), (3, 1)):
        for s in ["".join(r.choices("ACGT", k=200)), "".join(r.choices("ACGTN", [9, 9, 9, 9, 1], k=300)), "A" * 60 + "".join(r.choices("AC", k=60)), "ACG", ""]:
            at, h, reverse = mapping.minimizers(s.encode(), k, w)
            assert set(zip(at.tolist(), h.view(np.uint64).tolist(), strict=True)) == plain_minimizers(s, k, w)
            back, hb, rb = mapping.minimizers(turned(s).encode(), k, w) if "N" not in s else (None,) * 3
            if back is not None:
                assert {(len(s) - k - a, x, not z) for a, x, z in zip(back.tolist(), hb.tolist(), rb.tolist(), strict=True)} == set(zip(at.tolist(), h.tolist(), reverse.tolist(), strict=True))


def genome(r, sizes=(60_000, 30_000)):
    """Contigs with a repeat that stands in many places, a satellite, and letters that are no bases."""
    repeat = "".join(r.choices("ACGT", k=300))
    out = []
    for n in sizes:
        s = r.choices("ACGT", k=n)
        for _ in range(n // 2000):
            p = r.randrange(n - 300)
            s[p : p + 300] = repeat
        if n > 4000:
            p = r.randrange(n - 3000)
            s[p : p + 1500] = list("ACCTGT" * 250)
            s[n // 2 : n // 2 + 40] = "N" * 40
        out.append("".join(s))
    return out


def test_index_has_each_place_once(spark):
    contigs = genome(random.Random(1), (9_000, 500, 10, 0))
    ref = spark.createDataFrame([(i, f"c{i}", s) for i, s in enumerate(contigs)], "ref_index int, name string, sequence string")
    made = mapping.index(ref, 11, 6, rare=5, tile=400, overlap=40)
    got = sorted((x.ref_index, x.place, x.hash) for x in made.places.collect())
    want = sorted((i, int(p), int(h)) for i, s in enumerate(contigs) for p, h, _ in zip(*mapping.minimizers(s.encode(), 11, 6), strict=True))
    assert got == want
    counts = {}
    for _, _, h in want:
        counts[h] = counts.get(h, 0) + 1
    assert {x.hash: x.n for x in made.frequent.collect()} == {h: n for h, n in counts.items() if n > 5}
    assert all(x.frequent == (counts[x.hash] > 5) for x in made.places.collect())


def made_reads(r, contigs, n):
    """ordinal -> (read, contig, place, reverse, edited) of reads with mismatches, gaps and other ends."""
    out = {}
    for k in range(n):
        c = r.randrange(len(contigs))
        size = r.choice([80, 100, 120])
        p = r.randrange(len(contigs[c]) - size - 10)
        s = list(contigs[c][p : p + size])
        for _ in range(k % 4):
            at = r.randrange(5, len(s) - 5)
            kind = r.choice("MMID")
            s[at : at + (1 if kind == "M" else 3 if kind == "D" else 0)] = [] if kind == "D" else r.choices("ACGT", k=1 if kind == "M" else 2)
        s = "".join(s)
        back = r.random() < 0.5
        out[k] = (turned(s) if back else s, c, p, back)
    return out


def exact_best(read, contigs, band, sc):
    """The best score of a read at all places of all contigs, either strand, by `affine`."""
    best = mapping._NONE
    for s in (read, turned(read)):
        for contig in contigs:
            wide = len(s) + 2 * band
            padded = b"\0" * band + contig.encode() + b"\0" * (band + len(s))
            begins = range(0, len(contig) - len(s) // 2, band)
            windows = np.array([np.frombuffer(padded[b : b + wide], np.uint8) for b in begins])
            reads = np.broadcast_to(np.frombuffer(s.encode(), np.uint8), (len(windows), len(s)))
            best = max(best, int(mapping.affine(reads, windows, band, sc).score.max()))
    return best


def test_reads_find_their_places(spark):
    r = random.Random(6)
    contigs = genome(r)
    reads = made_reads(r, contigs, 400)
    ref = spark.createDataFrame([(i, f"c{i}", s) for i, s in enumerate(contigs)], "ref_index int, name string, sequence string")
    made = mapping.index(ref, tile=5000, overlap=300)
    rows = [(k, x[0]) for k, x in reads.items()] + [(1000, None), (1001, ""), (1002, "ACGT" * 5), (1003, "ACGNN" * 20), (1004, "".join(r.choices("ACGT", k=100))), (1005, reads[0][0].lower()), (1006, contigs[0][:60] + "T" * 40), (1007, "G" * 30 + contigs[1][-70:])]
    got = {x.ordinal: x for x in mapping.map_reads(spark.createDataFrame(rows, "ordinal long, base string").repartition(3).withColumn("note", F.lit("x")), made).collect()}
    assert len(got) == len(rows) and all(x.note == "x" for x in got.values())
    at_home = unique = 0
    for k, (read, c, p, back) in reads.items():
        a = got[k].aln
        if set(contigs[c][p : p + len(read)]) - set("ACGT"):
            continue
        assert got[k].score is not None, k
        shown = turned(read) if a.flag & 16 else read
        assert points(shown, contigs[a.position.ref_index], a.position.position, a.cigar, mapping.Scoring()) == got[k].score
        if a.mapping_quality > 3:
            unique += 1
            clip = int(re.match(r"(?:(\d+)S)?", a.cigar).group(1) or 0)
            home = (a.position.ref_index, a.flag, abs(a.position.position - clip - p) <= 12) == (c, 16 if back else 0, True)
            at_home += home
            if not home:  # a place that is better than the read's own
                own = np.frombuffer(contigs[c][max(0, p - 20) : p + len(read) + 40].encode().ljust(400, b"\0"), np.uint8)
                s = turned(read) if back else read
                there = mapping.affine(np.frombuffer(s.encode(), np.uint8)[None], own[None, : len(s) + 60], 30)
                assert got[k].score >= there.score[0], (k, a, c, p, back, there.score[0])
    assert unique > 200 and at_home >= 0.97 * unique
    for k in list(reads)[:8]:  # nothing better stands anywhere
        if not set(reads[k][0]) - set("ACGT"):
            assert got[k].score >= exact_best(reads[k][0], contigs, mapping.BAND, mapping.Scoring()) or got[k].chains > mapping.CANDIDATES, k
    assert [got[k].aln.flag for k in range(1000, 1005)] == [4] * 5 and all(got[k].score is None for k in range(1000, 1005))
    assert got[1005].aln == got[0].aln
    assert (got[1006].aln.cigar[-2:], got[1007].aln.cigar[:3]) == ("0S", "30S") and got[1007].aln.position.position == len(contigs[1]) - 70
    assert max(x.chains or 0 for x in got.values()) > 10  # reads of repeats


def test_reads_of_frequent_minimizers_are_rescued(spark):
    r = random.Random(8)
    unit = "".join(r.choices("ACGT", k=200))
    contig = "".join("".join(r.choices("ACGT", k=100)) + unit for _ in range(40))
    ref = spark.createDataFrame([(0, "c", contig)], "ref_index int, name string, sequence string")
    made = mapping.index(ref, rare=10, tile=2000, overlap=200)
    assert made.frequent.count() > 0
    got = {x.ordinal: x for x in mapping.map_reads(spark.createDataFrame([(0, unit[50:130]), (1, turned(unit[50:130])), (2, contig[290:390])], "ordinal long, base string"), made).collect()}
    first = contig.index(unit[50:130])
    assert [(got[k].aln.position.position, got[k].aln.mapping_quality, got[k].aln.flag, got[k].chains) for k in (0, 1)] == [(first, 3, 0, 40), (first, 3, 16, 40)]
    assert got[2].aln.position.position == 290 and got[2].aln.mapping_quality > 3


def test_stored_index_is_not_shuffled(spark):
    r = random.Random(3)
    contigs = genome(r, (20_000,))
    ref = spark.createDataFrame([(0, "c0", contigs[0])], "ref_index int, name string, sequence string")
    mapping.write_index(mapping.index(ref, overlap=300), "genome_index", 4)
    made = mapping.read_index(spark, "genome_index")
    assert (made.k, made.window, made.overlap) == (mapping.K, mapping.WINDOW, 300)
    reads = spark.createDataFrame([(k, x[0]) for k, x in made_reads(r, contigs, 60).items()], "ordinal long, base string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mapping.anchors(mapping.seeds(reads, made.k, made.window), made.places, made.k)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1  # the reads' side
    columns = lambda i: sorted(map(repr, mapping.map_reads(reads, i).collect()))
    assert columns(made) == columns(mapping.index(ref, overlap=300))


def test_limits(spark):
    ref = spark.createDataFrame([(0, "c", "ACGT" * 100)], "ref_index int, name string, sequence string")
    with pytest.raises(ValueError, match="odd"):
        mapping.index(ref, 12)
    with pytest.raises(ValueError, match="overlap"):
        mapping.index(ref, overlap=20)
    with pytest.raises(ValueError, match="reads of 300"):
        mapping.map_reads(spark.createDataFrame([(1, "A" * 300)], "ordinal long, base string"), mapping.index(ref, overlap=100))
    empty = ref.where("false")
    assert [x.aln.flag for x in mapping.map_reads(spark.createDataFrame([(1, "ACGT" * 20)], "ordinal long, base string"), mapping.index(empty)).collect()] == [4]
    assert mapping.map_reads(spark.createDataFrame([], "ordinal long, base string"), mapping.index(ref)).collect() == []


def test_no_table_of_reads_or_places_is_broadcast(spark):
    """Spark takes what tasks make of a small file for small, and would send it whole to the driver."""
    contigs = spark.createDataFrame([(0, "c", "ACGTTGCATGCCATGGATCA" * 40)], "ref_index int, name string, sequence string")
    reads = spark.createDataFrame([(1, "ACGTTGCATGCCATGGATCA" * 4)], "ordinal long, base string")
    for found in (mapping.map_reads(reads, mapping.index(contigs, rare=2, overlap=256)), align.align(reads, contigs)):
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_other_bases_in_front_are_clipped(spark, tmp_path):
    """Fragments whose bases in front, made without regard to the contig, were placed by a gap with as high a score as clipped, or a higher one."""
    import duckdb
    from readloom.plans import queries

    with duckdb.connect() as c:
        some = ", ".join(str(k) for first in (44000, 64000, 155000, 188800, 516600) for k in range(first, first + 200))
        c.execute(f"CREATE TABLE events AS SELECT unnest([{some}])::BIGINT AS event_id, 1::BIGINT AS user_id")
        c.execute("CREATE TABLE part AS SELECT * FROM '/root/testdata/sf0.001/part.parquet'")
        for t in ("events", "part"):
            c.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet'")
        got = queries.QUERIES["map_edited_reads"](spark, str(tmp_path))
        want = c.sql(queries.ORACLE_SQL["map_edited_reads"])
        rows = want.select(*[duckdb.ColumnExpression(x) for x in got.columns]).fetchall()
    assert len(rows) > 900 and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows))


def test_front_has_no_word_of_the_contig():
    from readloom.plans import queries

    r = random.Random(8)
    for k in range(300):
        before, s = "".join(r.choices("ACGT" if k % 2 else "AC", k=32 if k % 3 else 0)), "".join(r.choices("ACGT" if k % 2 else "AC", k=128))
        front, around = queries._front(before, s), before[-24:] + s[:39]
        assert len(front) == 15 and all(a != b for a, b in zip(front, s, strict=False))
        assert not any(front[i : i + 4] in around for i in range(12))
    assert queries._front("A", "NNNN" + "ACGT" * 31)[:4] == "NNNN" and queries._front("A", None) is None
