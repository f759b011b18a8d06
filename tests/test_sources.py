"""Sources on small files and literals."""

import gzip

import numpy as np
import pytest

from gradmill import sources
from gradmill.catalog import files
from gradmill.operators import relational
from gradmill.operators.samples import running_total
from gradmill.session import get_session, scratch_dir
from gradmill.sources.images import byte_pixels


@pytest.fixture(scope="module")
def idx(tmp_path_factory):
    folder = tmp_path_factory.mktemp("idx")
    images = np.arange(6 * 16).reshape(6, 4, 4) * 2
    image_bytes, label_bytes = files.idx_pair(images, np.array([5, 0, 4, 1, 9, 2]))
    (folder / "images").write_bytes(image_bytes)
    (folder / "labels").write_bytes(label_bytes)
    (folder / "images.gz").write_bytes(gzip.compress(image_bytes))
    (folder / "labels.gz").write_bytes(gzip.compress(label_bytes))
    return folder, images


def test_session_is_reused_and_configured(spark):
    assert get_session("other").sparkContext is spark.sparkContext
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert scratch_dir(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")


@pytest.mark.parametrize("suffix,splits", [("", 1), ("", 2), ("", 4), (".gz", 3)])
def test_idx(spark, idx, suffix, splits):
    folder, images = idx
    df = sources.read_idx(spark, f"{folder}/images{suffix}", f"{folder}/labels{suffix}", splits)
    rows = df.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(6))
    assert [r["label"] for r in rows] == [5, 0, 4, 1, 9, 2]
    assert np.array_equal([r["pixels"] for r in rows], images.reshape(6, 16))
    assert df.rdd.getNumPartitions() == (1 if suffix else splits)


def test_idx_list_counts_on(spark, idx):
    folder, _ = idx
    df = sources.read_idx(
        spark, [f"{folder}/images", f"{folder}/images.gz"], [f"{folder}/labels.gz", f"{folder}/labels"]
    )
    rows = df.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(12))
    assert rows[3]["pixels"] == rows[9]["pixels"] and rows[3]["label"] == rows[9]["label"]


def test_idx_rejects_unequal_and_foreign_files(spark, idx, tmp_path):
    folder, images = idx
    (tmp_path / "labels").write_bytes(files.idx_pair(images, np.zeros(5))[1])
    with pytest.raises(Exception, match="6 images but 5 labels"):
        sources.read_idx(spark, f"{folder}/images", f"{tmp_path}/labels").collect()
    (tmp_path / "text").write_bytes(b"not an idx file")
    with pytest.raises(Exception, match="not an unsigned-byte IDX"):
        sources.read_idx(spark, f"{tmp_path}/text", f"{folder}/labels").collect()


def test_running_total(spark):
    rows = [(f"k{n:03d}", n * n % 7) for n in range(50)]
    want, total = {}, 0
    for key, n in rows:
        want[key], total = total, total + n
    for ranges in (1, 3, 60):
        df = running_total(spark.createDataFrame(rows, "key string, n long").repartition(5), "key", "n", "before", ranges)
        assert {r.key: r.before for r in df.collect()} == want


@pytest.fixture()
def idx_folder(tmp_path):
    """Seven pairs of 0 to 6 images, some of their files gzipped, one in a folder below."""
    rng, want = np.random.default_rng(2), []
    for n in range(7):
        images, labels = rng.integers(0, 256, (n, 3, 5)), rng.integers(0, 256, n)
        folder = tmp_path / "below" if n == 0 else tmp_path
        folder.mkdir(exist_ok=True)
        for kind, data, packed in zip(("images-idx3", "labels-idx1"), files.idx_pair(images, labels), (n % 2, n % 3 == 0)):
            path = folder / f"part{n}-{kind}-ubyte{'.gz' if packed else ''}"
            path.write_bytes(gzip.compress(data) if packed else data)
        want += zip(images.reshape(n, 15).tolist(), labels.tolist())
    return tmp_path, want


@pytest.mark.parametrize("threshold", ["10485760b", "1b"])
def test_idx_folder(spark, idx_folder, threshold):
    folder, want = idx_folder
    (folder / "notes.txt").write_text("something else")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = sources.read_idx_folder(spark, str(folder))
        assert df.dtypes == [("id", "bigint"), ("pixels", "array<float>"), ("label", "int")]
        rows = df.orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [r.id for r in rows] == list(range(len(want)))
    assert [(r.pixels, r.label) for r in rows] == want


def test_idx_folder_names_what_is_wrong(spark, idx_folder, tmp_path_factory):
    folder, _ = idx_folder
    assert sources.read_idx_folder(spark, str(tmp_path_factory.mktemp("empty"))).collect() == []
    image_bytes, label_bytes = files.idx_pair(np.zeros((4, 2, 2)), np.zeros(4))
    images, labels = (folder / f"x-{kind}-ubyte" for kind in ("images-idx3", "labels-idx1"))

    def fails(message):
        with pytest.raises(Exception, match=message):
            sources.read_idx_folder(spark, str(folder)).collect()

    images.write_bytes(image_bytes)
    fails("1 image files and 0 label files begin with .*/x-")
    labels.write_bytes(files.idx_pair(np.zeros((3, 2, 2)), np.zeros(3))[1])
    fails("4 images but 3 labels in .*/x-")
    labels.write_bytes(label_bytes)
    images.write_bytes(image_bytes[:-1])
    fails("cut short or too long: .*/x-")
    images.write_bytes(b"no" + image_bytes[2:])
    fails("not an unsigned-byte IDX")
    images.write_bytes(image_bytes)
    (folder / "x-images-idx3-ubyte.gz").write_bytes(gzip.compress(image_bytes))
    fails("2 image files and 1 label files begin with .*/x-")


@pytest.fixture(scope="module")
def flowers(tmp_path_factory):
    root = tmp_path_factory.mktemp("flowers")
    rng = np.random.default_rng(1)
    pictures = {}
    for split, kind, name in [
        ("train", "rose", "a"), ("train", "daisy", "b"), ("train", "tulip", "c"),
        ("val", "rose", "d"), ("val", "tulip", "e"),
    ]:
        pictures[name] = rng.integers(0, 256, (5, 4, 3))
        files.store(f"{root}/split={split}/label={kind}/{name}.png", files.png(pictures[name]))
        files.store(f"{root}/plain/{split}/{kind}/{name}.png", files.png(pictures[name]))
    files.store(f"{root}/split=train/label=rose/broken.png", b"no image")
    return root, pictures


@pytest.mark.parametrize("layout", ["", "/plain"])
def test_labelled_image_folder(spark, flowers, layout):
    root, pictures = flowers
    df = sources.image_folder(spark, f"{root}{layout}", "train")
    rows = df.select("path", "label_name", "label", "height", "width",
                     byte_pixels(df["data"]).alias("rgb")).collect()
    assert {(r["label_name"], r["label"]) for r in rows} == {("daisy", 0), ("rose", 1), ("tulip", 2)}
    assert len(rows) == 3  # the broken file is left out
    for r in rows:
        picture = pictures[r["path"].rsplit("/", 1)[1][0]]
        assert (r["height"], r["width"]) == (5, 4)
        assert r["rgb"] == picture.ravel().tolist()


def test_class_ids_can_be_given(spark, flowers):
    root, _ = flowers
    classes = sources.from_rows(
        spark, [("daisy", 0), ("rose", 1), ("tulip", 2)], "label_name string, label int"
    )
    val = sources.image_folder(spark, str(root), "val", classes=classes)
    assert {(r["label_name"], r["label"]) for r in val.collect()} == {("rose", 1), ("tulip", 2)}


def test_unlabelled_and_named_images(spark, flowers):
    root, _ = flowers
    df = sources.image_folder(spark, f"{root}/plain/train", has_label=False)
    assert df.count() == 3 and "label" not in df.columns
    names = {"first": f"{root}/plain/train/rose/a.png", "second": f"{root}/plain/val/rose/d.png"}
    named = sources.named_images(spark, names).collect()
    assert {r["name"]: r["path"].rsplit("/", 1)[1] for r in named} == {
        "first": "a.png", "second": "d.png",
    }


def files_read(df) -> int:
    """Files that the scans of the image format have opened."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    n, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan image"):
            n += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return n


def test_a_filter_on_the_label_opens_its_folder_only(spark, flowers):
    root, _ = flowers
    classes = sources.from_rows(spark, [("daisy", 0), ("rose", 1), ("tulip", 2)], "label_name string, label int")
    tulips = sources.image_folder(spark, str(root), "train", classes=classes).where("label_name = 'tulip'")
    assert [r["label"] for r in tulips.collect()] == [2]
    assert files_read(tulips) == 1
    every = sources.image_folder(spark, str(root), classes=classes)
    assert every.count() == 5 and files_read(every.where("label_name = 'rose'")) == 3
    plain = sources.image_folder(spark, f"{root}/plain", "val", classes=classes).where("label_name = 'rose'")
    assert [r["label"] for r in plain.collect()] == [1]


def test_labels_that_look_like_numbers_stay_strings(spark, tmp_path):
    for label in ("01", "1"):
        files.store(f"{tmp_path}/split=train/label={label}/x.png", files.png(np.zeros((2, 2, 3))))
    rows = sources.image_folder(spark, str(tmp_path), "train").collect()
    assert sorted((r["label_name"], r["label"]) for r in rows) == [("01", 0), ("1", 1)]


def test_a_list_of_names_opens_its_files_only(spark, tmp_path, monkeypatch):
    for n in range(12):
        (tmp_path / f"er {n % 3}").mkdir(exist_ok=True)
        (tmp_path / f"er {n % 3}" / f"p{n}.png").write_bytes(files.png(np.full((2, 2, 3), n)))
    names = spark.createDataFrame([(f"n{n}", f"{tmp_path}/er {n % 3}/p{n}.png") for n in (1, 5, 9)] + [("gone", f"{tmp_path}/no.png")], "name string, path string")
    named = sources.named_images(spark, names, str(tmp_path))
    assert {r["name"]: r["data"][0] for r in named.collect()} == {"n1": 1, "n5": 5, "n9": 9}
    assert files_read(named) == 3
    assert sources.named_images(spark, names.where("name = 'gone'"), str(tmp_path)).count() == 0
    monkeypatch.setattr("gradmill.sources.images.LISTED", 2)  # a longer list is joined to the scan
    assert sources.named_images(spark, names, str(tmp_path)).count() == 3


def test_image_data_dispatch(spark, flowers, tmp_path):
    root, pictures = flowers
    assert sources.image_data(spark, str(root), "image", "train").count() == 3
    rows = [("rose", pictures["a"].ravel().tolist()), ("tulip", pictures["c"].ravel().tolist())]
    table = sources.from_rows(spark, rows, "label string, rgb array<int>")
    files.write_sequence(table, f"{tmp_path}/seq/train", "label", "rgb")
    seq = sources.image_data(spark, f"{tmp_path}/seq", "seq", "train", (5, 4, 3))
    got = seq.select("label_name", byte_pixels(seq["data"], bgr=False).alias("rgb")).collect()
    assert sorted((r["label_name"], r["rgb"]) for r in got) == sorted(rows)
    with pytest.raises(ValueError, match="unknown file type"):
        sources.image_data(spark, "x", "tar")
    with pytest.raises(ValueError, match="image shape"):
        sources.image_data(spark, "x", "seq")


def test_class_list_keeps_the_blank_first_class(spark, tmp_path):
    path = tmp_path / "classes.txt"
    path.write_text('\ntench, Tinca tinca\ngoldfish, Carassius auratus\n"pen, quill",biro\n"say ""hi""", b"c')
    rows = sources.class_list(spark, str(path)).orderBy("class_id").collect()
    assert [(r["class_id"], r["synonyms"]) for r in rows] == [
        (0, []), (1, ["tench", "Tinca tinca"]), (2, ["goldfish", "Carassius auratus"]),
        (3, ["pen, quill", "biro"]), (4, ['say "hi"', 'b"c']),
    ]


def test_label_lines_end_with_a_line_break(spark, tmp_path):
    path = tmp_path / "labels.txt"
    path.write_text("dummy\n tench \ncrane\t\ncrane\n")
    rows = sources.label_lines(spark, str(path)).orderBy("class_id").collect()
    assert [tuple(r) for r in rows] == [(0, "dummy"), (1, " tench"), (2, "crane"), (3, "crane")]


def test_text_lines_from_strings_and_files(spark, tmp_path):
    kept = sources.text_lines(spark, ["disk sda failed\n", "disk sdb failed again\n", "disk sdc spins\n"])
    assert kept.columns == ["line"] and kept.first()["line"].endswith("\n")
    assert relational.like_count(kept, "line", "%failed%").first()["matches"] == 2
    (tmp_path / "log").write_text("a\nb\n")
    assert [r["line"] for r in sources.text_lines(spark, str(tmp_path / "log")).collect()] == ["a", "b"]


PEOPLE = [
    '{"name": "Ines", "address": {"city": "Porto", "state": "Norte"}, "age": 41}',
    '{"name": "Jonas", "address": {"city": "Graz", "state": null}, "height": 1.85}',
    "no JSON at all", None,
]


def test_json_strings_inferred_view_and_filter(spark):
    table = sources.from_rows(spark, [(s,) for s in PEOPLE], "json string")
    df = sources.read_json_strings(table, "json").select("parsed.*")
    assert df.schema.simpleString() == (
        "struct<address:struct<city:string,state:string>,age:bigint,height:double,name:string>"
    )
    rows = relational.view_filter(df, "people", "name", "Jonas").collect()
    assert [r.asDict(True) for r in rows] == [
        {"address": {"city": "Graz", "state": None}, "age": None, "height": 1.85, "name": "Jonas"}
    ]
    none = sources.from_rows(spark, [("[1]",), (None,)], "json string")
    assert sources.read_json_strings(none, "json").schema["parsed"].dataType.simpleString() == "struct<>"


def test_word_count_counts_empty_tokens(spark):
    df = sources.from_rows(spark, [("red",), ("red fish",), ("x  y ",)], "line string")
    counts = {r["word"]: r["count"] for r in relational.word_count(df, "line").collect()}
    assert counts == {"red": 2, "fish": 1, "x": 1, "y": 1, "": 2}
