"""Operations on text corpora for training data; nothing else in the library imports them."""
