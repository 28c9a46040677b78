SF_DIR = "/root/testdata/sf0.001"
LARGER_DIR = "/root/testdata/sf0.1"
