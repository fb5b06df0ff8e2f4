import pytest

from platewise.operators import images as I
from platewise.plans.loaddata import ImageSetFiles, image_set_table, write_image_sets
from platewise.sources.listing import list_files


def names(wells=("A02",), sites=(1, 2), channels=(1, 2, 3, 4, 5)):
    """Paths of one scan, the channels of a site side by side."""
    spots = [(w, s) for w in wells for s in sites]
    return [f"T/scan7_{w}_s{s}_w{c}_z0.tif" for w, s in spots for c in channels]


def parsed(spark, paths):
    return I.parse_images(spark.createDataFrame([(p,) for p in paths], "path string"), plate="plateX")


def test_parse_skips_thumbnails_foreign_names_and_unknown_channels(spark):
    extra = ["T/scan7_A02_s1_w1_THUMBx.tif", "T/readme.tif", "T/scan7_A02_s1_w6X.tif", "T/scan7_Q02_s1_w1.tif"]
    rows = parsed(spark, names(sites=(1,)) + extra).collect()
    assert sorted((r.Well, r.Site, r.ChannelNumber) for r in rows) == [("A02", 1, c) for c in range(1, 6)]
    assert rows[0].FileName.startswith("scan7_A02")


def test_no_image_raises(spark):
    with pytest.raises(FileNotFoundError):
        I.require_images(parsed(spark, ["T/other.tif"]))


def test_image_sets_columns_and_values(spark):
    sets = image_set_table(parsed(spark, names()), with_illum=True).orderBy("Metadata_Site")
    first = sets.first()
    assert sets.count() == 2
    assert first.Image_FileName_OrigMito == "scan7_A02_s1_w2_z0.tif"
    assert first.Image_PathName_OrigER == "images"
    assert (first.Image_FileName_IllumRNA, first.Image_PathName_IllumRNA) == ("IllumRNA.npy", "illum")
    assert not [c for c in I.image_sets(parsed(spark, names())).columns if "Illum" in c]


def test_later_path_wins_component_by_component(spark):
    # As plain text "T-2/..." sorts before "T/..."; by component it sorts after.
    paths = names() + ["T-2/scan7_A02_s1_w1_z9.tif"]
    first = I.image_sets(parsed(spark, paths)).orderBy("Metadata_Site").first()
    assert first.Image_FileName_OrigDNA == "scan7_A02_s1_w1_z9.tif"


def test_missing_channels_are_reported_and_raise(spark):
    images = parsed(spark, names(channels=(1, 3, 5)))
    assert [tuple(r) for r in I.incomplete_sets(images).orderBy("Metadata_Site").collect()] == [
        ("plateX", "A02", 1, "w2, w4"),
        ("plateX", "A02", 2, "w2, w4"),
    ]
    with pytest.raises(ValueError, match="site 1 of well A02, plate plateX.*w2, w4"):
        image_set_table(images)


def test_chunks_and_manifest(spark):
    sets = I.image_sets(parsed(spark, names(wells=("A02", "B03"), sites=(2, 10, 1))))
    chunked = I.chunked_sets(sets, 4)
    order = chunked.orderBy("chunk", "Metadata_Well", "Metadata_Site").collect()
    assert [(r.Metadata_Well, r.Metadata_Site, r.chunk) for r in order] == [
        ("A02", 1, 1), ("A02", 2, 1), ("A02", 10, 1), ("B03", 1, 1), ("B03", 2, 2), ("B03", 10, 2),
    ]
    manifest = I.chunk_manifest(chunked).collect()
    second = [r.FileName for r in manifest if r.chunk == 2]
    assert len(second) == 10 and second == sorted(second)


@pytest.fixture
def plate(tmp_path):
    root = tmp_path / "plateX"
    (root / "TimePoint_1").mkdir(parents=True)
    for name in names():
        (root / "TimePoint_1" / name.split("/")[1]).touch()
    (root / "TimePoint_1" / "scan7_A02_s1_w1_thumbX.tif").touch()
    (root / "TimePoint_1" / "upper_A02_s1_w1.TIF").touch()
    (root / "_A02_s1_w1.tif").touch()
    return root


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_listing_keeps_empty_and_underscored_files(spark, plate, depth):
    found = [r.path for r in list_files(spark, str(plate), depth=depth).collect()]
    assert len(found) == len(set(found)) == 12


def test_image_sets_from_a_folder(spark, plate, tmp_path):
    result = write_image_sets(spark, str(plate), str(tmp_path / "out"), chunk_size=1)
    assert result == ImageSetFiles("plateX", 2, 2)
    table = spark.read.option("header", "true").csv(str(tmp_path / "out" / "load_data.csv"))
    assert [r.Metadata_Site for r in table.collect()] == ["1", "2"]
    listed = spark.read.text(str(tmp_path / "out" / "chunks" / "chunk2.images.txt"))
    assert [r.value for r in listed.collect()] == [f"scan7_A02_s2_w{c}_z0.tif" for c in range(1, 6)]
    chunk = spark.read.option("header", "true").csv(str(tmp_path / "out" / "chunks" / "chunk*.load_data.csv"))
    assert chunk.columns == table.columns and chunk.count() == 2
