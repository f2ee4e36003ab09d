import json

import pytest

from sightline.operators import labels
from sightline.plans.label_map import ID_COLUMNS, build_label_map
from sightline.sources import documents
from conftest import pairs


def test_overrides_come_first(frame):
    out = labels.resolve_labels(
        frame([("A1",), ("A2",), ("A3",), ("A4",)], "object_id string"),
        frame([("A1", "Screw"), ("A4", None)], "object_id string, label string"),
        frame([("A1", "not used"), ("A2", "Bolt"), ("A4", "not used")], "object_id string, label string"),
    )
    assert {r.object_id: (r.label, r.mapped) for r in out.collect()} == {
        "A1": ("Screw", True), "A2": ("Bolt", True), "A3": (None, False), "A4": (None, True),
    }


def test_unmapped(frame):
    ids = frame([(f"A{i:02}",) for i in range(15)], "object_id string")
    known = frame([("A00",)], "object_id string")
    unmapped = labels.unmapped_ids(ids, known, None)
    sample = labels.unmapped_sample(unmapped).collect()
    assert [r.object_id for r in sample] == [f"A{i:02}" for i in range(1, 11)]
    assert {r.total_unmapped for r in sample} == {14}


def test_group_and_reverse(frame):
    flat = frame([("A1", "Screw"), ("A2", "Bolt"), ("A3", "Screw")], "object_id string, label string")
    grouped = labels.group_by_label(flat)
    assert {r.label: r.object_ids for r in grouped.collect()} == {"Bolt": ["A2"], "Screw": ["A1", "A3"]}
    assert pairs(labels.reverse_label_map(grouped), "object_id", "label") == {"A1": "Screw", "A2": "Bolt", "A3": "Screw"}


def test_pieces_of_a_hot_label_are_one_sorted_list(spark, frame):
    """A label with half of all rows, in no order, a hot repeated ID, NULL labels and NULL IDs."""
    hot = [f"H{(i * 7919) % 3000:04}" for i in range(3000)]
    rows = [(x, "hot") for x in hot] + [("same", "copies")] * 1500 + [(f"C{i % 700:03}", f"cold{i % 9}") for i in range(1400)]
    rows += [("N2", None), ("N1", None), (None, "hot"), (None, None)]
    table = frame(rows, "object_id string, label string").repartition(5)
    grouped = labels.group_by_label(table, size=64).collect()
    lists = {}
    for r in sorted(grouped, key=lambda r: r.piece):
        assert r.piece == len(lists.setdefault(r.label, [])) // 64 and len(lists[r.label]) % 64 == 0
        lists[r.label] += r.object_ids
    expected = {}
    for object_id, label in rows:
        if object_id is not None:
            expected.setdefault(label, []).append(object_id)
    assert lists == {label: sorted(ids) for label, ids in expected.items()}
    assert max(len(r.object_ids) for r in grouped) == 64


def test_no_labels_give_no_pieces(frame):
    assert labels.group_by_label(frame([], "object_id string, label string")).collect() == []


def test_duplicate_ids_raise(frame):
    grouped = frame([("Screw", ["A1"]), ("Bolt", ["A1", "A2"])], "label string, object_ids array<string>")
    with pytest.raises(Exception, match="Duplicate ObjectID found: A1"):
        labels.reverse_label_map(grouped).collect()
    assert pairs(labels.duplicate_ids(grouped), "object_id", "n") == {"A1": 2}


def test_default_only_for_unknown_ids(frame):
    known = frame([("A1", "Screw"), ("A2", None)], "object_id string, label string")
    out = labels.label_lookup_default(frame([("A1",), ("A2",), ("A3",)], "object_id string"), known)
    assert pairs(out, "object_id", "label") == {"A1": "Screw", "A2": None, "A3": "UNKNOWN"}


def test_synonyms(frame):
    table = frame([("light bulb", "bulbs")], "category string, canonical string")
    out = labels.synonym_join(frame([("Light_Bulb",), ("Unmapped label",), (None,)], "l string"), table, "l", "c")
    assert [r.c for r in out.orderBy("c").collect()] == ["bulbs", "none", "unmapped label"]


@pytest.mark.parametrize("unknown_word", [None, "Mystery_Thing"])
def test_dual_truth(frame, unknown_word):
    synonyms = [("bolt", "bolts")] + ([("unknown", unknown_word)] if unknown_word else [])
    out = labels.dual_truth_join(
        frame([("A1",), ("A2",), ("A3",), ("A4",)], "object_id string"),
        frame([("A1", "Bolt"), ("A3", "Nut_Small")], "object_id string, label string"),
        frame([("A1", "Fastener"), ("A2", "Raw_Label"), ("A4", None)], "object_id string, label string"),
        frame(synonyms, "category string, canonical string"),
    )
    miss = "mystery thing" if unknown_word else "unknown"
    assert {r.object_id: (r.mobileclip_gt, r.classifier_gt) for r in out.collect()} == {
        "A1": ("bolts", "Fastener"), "A2": (miss, "Raw_Label"), "A3": ("nut small", "UNKNOWN"), "A4": (miss, None),
    }


def test_limit_images(frame):
    df = frame([(i, f"p{i}") for i in range(1, 8)], "pos int, image_path string")
    assert labels.limit_images(df, -1).count() == 7
    assert [r.pos for r in labels.limit_images(df, 3).orderBy("pos").collect()] == [1, 2, 3]
    assert [r.pos for r in labels.limit_images(df, 3, order=["pos"]).collect()] == [1, 2, 3]


def test_unknown_classes(frame):
    df = frame([("a",), ("b",), ("b",), ("x",), (None,)], "classifier_gt string")
    encoder = frame([(0, "a"), (1, "b")], "label_idx int, label string")
    assert labels.known_class_filter(df, encoder).count() == 3
    assert labels.skipped_unknown(df, encoder).first().skipped == 2
    assert labels.skipped_unknown(df.filter("classifier_gt = 'a'"), encoder).first().skipped == 0


# --- label maps from files ---------------------------------------------------------------------


@pytest.mark.parametrize("split", ["train", "test"])
@pytest.mark.parametrize("truth", ["classifier", "mobileclip"])
def test_label_map_from_files(spark, tmp_path, split, truth):
    """Three listed objects: one with two names, one with a padded name, one without any."""
    paths = [f"LOT7/LOT7_{name}_IM{shot}.jpg" for name in ("K-10", "K-11", "K-12") for shot in (1, 22)]
    column = ID_COLUMNS[split]
    files = {
        "listed.json": json.dumps([{"prefix": "file:///images/"}, *paths]),
        "names.csv": f'{column},name\n"K-10 ",Hinge\nK-11," Door, left "\nK-99,Nobody\n',
        "curated.json": '{"K-10": "Bracket", "K-98": null}',
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    out = build_label_map(
        documents.read_manifest(spark, str(tmp_path / "listed.json")),
        documents.read_id_name_csv(spark, str(tmp_path / "names.csv"), column),
        documents.read_override_map(spark, str(tmp_path / "curated.json")),
        truth,
    )
    first = "Bracket" if truth == "classifier" else "Hinge"
    assert {r.object_id: (r.label, r.mapped) for r in out.collect()} == {
        "K-10": (first, True), "K-11": ("Door, left", True), "K-12": (None, False),
    }


def test_unknown_ground_truth(frame):
    with pytest.raises(ValueError):
        build_label_map(frame([("p",)], "image_path string"), None, None, "other")
