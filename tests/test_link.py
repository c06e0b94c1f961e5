import numpy as np
import pytest

from kindred import __main__ as cli
from kindred.plans import link
from kindred.sources import files


def test_files_to_decisions(spark, tmp_path):
    rng = np.random.default_rng(3)
    letters = [*"abcdefghijklmnoprstuv"]
    names = ["".join(rng.choice(letters, 6)) + " " + "".join(rng.choice(letters, 5)) for _ in range(120)]
    s1, s2, gt = ["entity_id\tbusiness_name\tbusiness_address\tcountry"], ["entity_id\tbusiness_name\tbusiness_address\tcountry"], ["source1_entity_id\tmatched_entity_ids"]
    s2b = list(s2)
    for k, n in enumerate(names, 1):
        s1.append(f"S1-{k:04d}\t{n.title()} Pvt Ltd\t{k} Main Street, Austin, TX\t{['US', 'France'][k % 2]}")
        if k % 5:
            s3 = s2b if k % 3 == 0 else s2
            s3.append(f"S{3 if k % 3 == 0 else 2}-{k}\t{n} LLC\t{k} Main St, Austin, Texas\t{['us', 'france'][k % 2]}")
        gt.append(f"S1-{k:04d}\t{f'S{3 if k % 3 == 0 else 2}-{k}' if k % 5 else ''}")
    for name, lines in (("s1", s1), ("s2", s2), ("s3", s2b), ("gt", gt)):
        (tmp_path / f"{name}.tsv").write_text("\n".join(lines) + "\n")
    at = lambda n: str(tmp_path / n)
    both = at("s2.tsv") + "," + at("s3.tsv")
    assert not cli.preflight(spark, at("s1.tsv"), both, at("out"))["all_ok"]
    told = cli.train(spark, at("s1.tsv"), both, at("gt.tsv"), at("out"))
    assert cli.preflight(spark, at("s1.tsv"), both, at("out"), 0.001)["all_ok"] and not cli.preflight(spark, at("s1.tsv"), at("none.tsv"), at("out"), 0.001)["all_ok"]
    assert told["recall"]["found"] == told["recall"]["true_pairs"] == 96
    made = cli.run(spark, at("s1.tsv"), both, at("out"))
    assert made["matches"]["rows"] == 120 and made["parts"]["made"] == 4
    assert cli.run(spark, at("s1.tsv"), both, at("out"))["parts"]["kept"] == 4
    files.write_json(spark, at("out/rule.json"), {"threshold": 0.99, "top_k": 0, "relative": 0.0})
    with pytest.raises(files.SubmissionError, match="rule was"):
        cli.run(spark, at("s1.tsv"), both, at("out"))
    lines = (tmp_path / "out/matches.tsv").read_text().splitlines()
    right = sum(a == b for a, b in zip(lines[1:], gt[1:]))
    assert lines[1].startswith("S1-0001\t") and right > 110


def test_mask_arithmetic():
    h = [(1, 10, 5), (3, 4, 4), (4, 100, 1)]
    assert link.leave_one_out(h)["name"] == (10, 5) and link.leave_one_out(h)["phonetic"] == (0, 0)
    order = link.greedy(h)
    assert order[0] == ("phonetic", 4, 4) and order[1] == ("name", 14, 9) and order[2] == ("structured", 114, 10)
