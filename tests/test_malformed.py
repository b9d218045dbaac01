import pytest

from wortfund.sources import xml_dump

GOOD = "<page><title>a</title><ns>0</ns><id>1</id><revision><text x=\"y\">body</text></revision></page>"
BAD = {
    "entity": "<page><title>b</title><ns>0</ns><id>2</id><revision><text x=\"y\">a &nope; b</text></revision></page>",
    "control": "<page><title>b</title><ns>0</ns><id>2</id><revision><text x=\"y\">a \x01 b</text></revision></page>",
    "unclosed": "<page><title>b</title><ns>0</ns><id>2</id><revision><text x=\"y\">a</revision></page>",
    "id": "<page><title>b</title><ns>0</ns><id>two</id><revision><text x=\"y\">a</text></revision></page>",
    "cut": "<page><title>b</title><ns>0</ns><id>2</id><revision><text x=\"y\">a",
}


@pytest.mark.parametrize("kind", sorted(BAD))
def test_malformed_pages_are_not_lost(spark, tmp_path, kind):
    path = tmp_path / "dump.xml"
    path.write_text(f"<mediawiki>{GOOD}\n{BAD[kind]}" + ("" if kind == "cut" else "</mediawiki>"))
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        xml_dump.scan_xml_pages(spark, str(path)).collect()
    assert [r.id for r in xml_dump.scan_xml_pages(spark, str(path), skip_malformed=True).collect()] == [1]
    assert len(xml_dump.malformed_pages(spark, str(path)).collect()) == 1
