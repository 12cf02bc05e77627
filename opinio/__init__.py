"""opinio: public-opinion analytics (posts -> labels -> topic x sentiment -> reports) on Spark."""
