"""Supply-chain order analytics as composable, lazy Spark DataFrame functions."""
