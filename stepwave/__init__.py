"""Motion-cycle analytics on Spark: readings in, periodic segments, fixed-length vectors and identities out."""
