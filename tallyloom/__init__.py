"""Survey analytics as Spark jobs: land, conform, measure, shape."""
