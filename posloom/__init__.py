"""posloom: retail point-of-sale cleaning and conforming as Spark jobs."""
