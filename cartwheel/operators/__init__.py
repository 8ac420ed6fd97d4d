"""DataFrame -> DataFrame operators (cleaning, features, quality, exploration,
recommenders, text, vectors, evaluation)."""
