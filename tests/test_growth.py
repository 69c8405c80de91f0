"""The stream against a loop that folds batch after batch."""

import os
import random


from corpusforge.sources.registry import sources_frame
from corpusforge.streaming.growth import prepare_base, start_growth

ITEMS = "source string, page_no long, pos long, title string, href string"


class Growth:
    def __init__(self, spark, tmp_path, base, sources, labels, target):
        self.spark, self.root, self.labels, self.target = spark, str(tmp_path), labels, target
        self.reg = sources_frame(spark, [{"name": n, "label": l, "base_url": "https://x/"} for n, l in sources])
        self.base = prepare_base(spark, spark.createDataFrame(base, "text string, label string"), f"{self.root}/base")
        os.makedirs(f"{self.root}/in")
        self.files = 0

    def arrive(self, *batches):
        """A file for each batch of (source, page, pos, title)."""
        for rows in batches:
            self.files += 1
            rows = [(*r, f"/{r[0]}/{r[1]}/{r[2]}") for r in rows]
            self.spark.createDataFrame(rows, ITEMS).coalesce(1).write.parquet(f"{self.root}/in/part={self.files}")
            os.utime(next(p.path for p in os.scandir(f"{self.root}/in/part={self.files}") if p.name.endswith(".parquet")), (1000 + self.files,) * 2)
        q = start_growth(self.spark, f"{self.root}/in/*", self.base, self.reg, self.labels, self.target, f"{self.root}/out",
                         f"{self.root}/checkpoint", files_per_batch=1)
        q.awaitTermination()

    def rows(self):
        out = self.spark.read.parquet(f"{self.root}/out").collect()
        return sorted((int(r["batch_id"]), r["label"], r["source"], r["page_no"], r["pos"], r["text"]) for r in out)


def loop(base, sources, labels, target, batches):
    norm = lambda t: " ".join(t.lower().split())
    seen = {norm(t) for t, _ in base}
    have = {l: sum(x == l for _, x in base) for l in labels}
    out = []
    for b, rows in enumerate(batches):
        for label in labels:
            for name, own in sources:
                for source, page, pos, title in sorted(rows):
                    if own == label and source == name and have[label] < target and len(title) >= 12 and norm(title) not in seen:
                        seen.add(norm(title))
                        have[label] += 1
                        out.append((b, label, name, page, pos, title))
    return sorted(out)


def test_batches_with_restarts_equal_the_loop(spark, tmp_path):
    """Titles come again, in other letters, under other labels, before and after
    their label has filled up."""
    rng = random.Random(4)
    sources = [("s1", "A"), ("s2", "A"), ("s3", "B"), ("s4", "C")]
    title = lambda: f"{rng.choice(['The', 'the', ' THE'])} headline number {rng.randint(0, 45)}"
    batches = [
        [(s, page, pos, title()) for s, _ in sources for page in (1, 2) for pos in range(rng.randint(0, 3))] for _ in range(6)
    ]
    base = [(title(), "C") for _ in range(3)] + [("short", "B")]
    g = Growth(spark, tmp_path, base, sources, ["A", "B", "C"], 11)
    g.arrive(*batches[:2])
    assert g.rows() == loop(base, sources, ["A", "B", "C"], 11, batches[:2])
    g.arrive(*batches[2:])  # a new query on the same checkpoint
    expected = loop(base, sources, ["A", "B", "C"], 11, batches)
    assert g.rows() == expected
    assert {l: sum(r[1] == l for r in expected) for l in "ABC"}["A"] == 11  # full on the way


def test_a_title_cut_by_its_quota_is_still_new_under_another_label(spark, tmp_path):
    sources = [("s", "A"), ("t", "B")]
    batches = [[("s", 1, 0, "first headline of all"), ("s", 1, 1, "second headline of all")], [("t", 1, 0, "Second headline of ALL"), ("t", 1, 1, "first headline of all")]]
    g = Growth(spark, tmp_path, [], sources, ["A", "B"], 1)
    g.arrive(*batches)
    assert [r[5] for r in g.rows()] == ["first headline of all", "Second headline of ALL"]


def test_the_same_input_again_adds_nothing_and_full_labels_give_empty_batches(spark, tmp_path):
    rows = [("s", p, i, f"headline s {p} number {i}") for p in (2, 1) for i in (1, 0)]
    g = Growth(spark, tmp_path, [("an existing headline", "A")], [("s", "A")], ["A"], 4)
    g.arrive(rows, rows, [("s", 9, 0, "yet another headline")])
    assert [(r[0], r[3], r[4]) for r in g.rows()] == [(0, 1, 0), (0, 1, 1), (0, 2, 0)]  # the quota is a prefix over pages
    assert sorted(x for x in os.listdir(f"{g.root}/out") if x.startswith("batch_id")) == [f"batch_id={b}" for b in range(3)]


def test_a_replayed_batch_rewrites_its_folder(spark, tmp_path):
    """The driver is lost after the output is written and before the commit."""
    g = Growth(spark, tmp_path, [], [("s", "A"), ("t", "B")], ["A", "B"], 5)
    g.arrive([("s", 1, 0, "first headline of all")], [("t", 1, 0, "first headline of all"), ("t", 1, 1, "second headline of all")])
    before = g.rows()
    os.remove(f"{g.root}/checkpoint/commits/1")
    if os.path.exists(f"{g.root}/checkpoint/commits/.1.crc"):
        os.remove(f"{g.root}/checkpoint/commits/.1.crc")
    g.arrive()
    assert g.rows() == before == [(0, "A", "s", 1, 0, "first headline of all"), (1, "B", "t", 1, 1, "second headline of all")]


def test_labels_without_a_source_are_no_error(spark, tmp_path):
    g = Growth(spark, tmp_path, [], [("s", "A")], ["A", "B"], 5)
    g.arrive([("s", 1, 0, "first headline of all")])
    assert len(g.rows()) == 1


