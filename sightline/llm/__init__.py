"""Operations of a training-data pipeline: text fingerprints, language, near copies, personal data, packing and more."""
