"""Where the tests find their tables."""

SF_SMALL = "/root/testdata/sf0.001"
