import random
import string

from linewise.plans import text_jobs as tj

def letter_lines(n=30, seed=5):
    """Own lines: two halves with exactly one common letter; three lines in a row share exactly one."""
    rng, lines, half_total, batch_total = random.Random(seed), [], 0, 0
    letters = string.ascii_letters
    for _ in range(n // 3):
        badge, *rest = rng.sample(letters, 1 + 3 * 7)
        batch_total += letters.index(badge) + 1
        for k in range(3):
            own = rest[7 * k:7 * k + 7]
            both, left, right = own[0], [*own[1:4], badge], own[4:7] + [own[4]]
            half_total += letters.index(both) + 1
            halves = [[both, *left], [both, *right]]
            for h in halves:
                rng.shuffle(h)
            lines.append("".join(halves[0] + halves[1]))
    return lines, half_total, batch_total


LAYOUT = ["    [D]    ", "[N] [C]    ", "[Z] [M] [P]", " 1   2   3 "]


def _file(tmp_path, name, lines, final_newline=False):
    path = tmp_path / name
    path.write_text("\n".join(lines) + ("\n" if final_newline else ""))
    return str(path)


def test_record_jobs_on_example(spark, tmp_path):
    p = _file(tmp_path, "cal.txt", ["1000", "2000", "3000", "", "4000", "", "5000", "6000", "", "7000", "8000",
                                    "9000", "", "10000"])
    assert tj.largest_record_total(spark, p).first()[0] == 24000
    assert tj.top_records_total(spark, p).first()[0] == 45000


def test_code_pair_jobs_on_example(spark, tmp_path):
    p = _file(tmp_path, "rps.txt", ["A Y", "B X", "C Z"], final_newline=True)
    r = tj.code_pair_totals(spark, p).first()
    assert (r.total_points, r.new_total_points) == (15, 12)


def test_letter_jobs_on_own_lines(spark, tmp_path):
    lines, half_total, batch_total = letter_lines()
    p = _file(tmp_path, "letters.txt", lines)
    assert tj.half_common_total(spark, p).first()[0] == half_total
    assert tj.batch_common_total(spark, p).first()[0] == batch_total


def test_interval_jobs_on_example(spark, tmp_path):
    p = _file(tmp_path, "pairs.txt", ["2-4,6-8", "2-3,4-5", "5-7,7-9", "2-8,3-7", "6-6,4-6", "2-6,4-8"])
    got = {r.label: (r.n_pairs, r.n_contained) for r in tj.interval_pair_counts(spark, p).collect()}
    assert got == {"overlap": (4, 2), "disjoint": (2, 0)}


def test_layout_job_on_example(spark, tmp_path):
    p = _file(tmp_path, "crates.txt", LAYOUT + ["", "move 1 from 2 to 1"])
    rows = tj.layout_block(spark, p, n_lines=4, positions=(1, 5, 9)).orderBy("line_no").collect()
    assert [(r.list1, r.list5, r.list9) for r in rows] == [(" ", "D", " "), ("N", "C", " "), ("Z", "M", "P"),
                                                            ("1", "2", "3")]
