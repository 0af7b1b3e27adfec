"""What the test modules share."""

SMALL = "/root/testdata/sf0.001"
