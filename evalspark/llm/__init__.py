"""Operations of a training-data pipeline: text in, decisions and formatted text out."""
