"""gradmill: data preparation, distributed learning and scoring as Spark jobs."""
