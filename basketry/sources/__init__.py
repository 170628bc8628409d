"""Entity schemas, file readers and writers, and the star-schema adapter."""
