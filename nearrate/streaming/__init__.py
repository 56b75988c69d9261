from nearrate.streaming.scoring import BaselineModel, fit_baseline, score_stream

__all__ = ["BaselineModel", "fit_baseline", "score_stream"]
