"""emberline: player-retention analytics as Spark DataFrame jobs."""
