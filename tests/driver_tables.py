"""Where the driver's tables lie; kept out of conftest.py, which a folder below may shadow."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
