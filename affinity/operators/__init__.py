"""DataFrame -> DataFrame operators of the recommender and click-log jobs."""
