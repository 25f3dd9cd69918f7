"""Records of which only some fields are built."""

from bibweave.operators import mods


def test_fields_give_the_tables_made_of_them_with_the_same_rows(spark):
    record = "<recordInfo><recordIdentifier>rec:{}</recordIdentifier></recordInfo></mods>"
    bodies = ['<genre type="a">g</genre><name type="personal"><namePart type="family">F</namePart></name>', "<language>text only</language><genre>x</genre>", "<genre>cut off", '<note a="1" a="2"/><genre/>']
    docs = spark.createDataFrame([("<mods>" + b + record.format(i),) for i, b in enumerate(bodies)], "mods string")
    whole = mods.tables(mods.parse(docs))
    for name, field in mods.TABLE_FIELDS.items():
        some = mods.tables(mods.parse(docs, fields=[field]))
        assert set(some) == {n for n, f in mods.TABLE_FIELDS.items() if f in (field, "recordInfo")}
        assert some[name].collect() == whole[name].collect() and some[name].schema == whole[name].schema
    assert len(whole) == 15 and whole["recordInfo"].count() == 2
