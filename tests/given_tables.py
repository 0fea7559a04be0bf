"""Where the given tables lie. Not in a conftest, of which the folders below have their own."""

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"
