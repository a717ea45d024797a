"""Column functions: JVM expressions first, Arrow-batched Python only for the inputs they cannot cover."""
