"""Command line of the file-to-file work: ``python -m foldmark <command> ...``."""

from __future__ import annotations

import argparse

from foldmark.operators.ensemble import SUBMISSION_CUTOFFS, VALIDATION_CUTOFFS
from foldmark.plans import experiment, studies, training
from foldmark.plans.boosting import BoostParams
from foldmark.session import build_session
from foldmark.sources.images import read_images
from foldmark.sources.samples import load_sample_sets
from foldmark.sources.tables import read_submission


def named(text: str) -> tuple[str, str]:
    """``name=value``."""
    name, sign, value = text.partition("=")
    if not sign or not name or not value:
        raise argparse.ArgumentTypeError(f"{text!r} is not name=value")
    return name, value


def roots(values: list[tuple[str, str]]) -> dict[str, str] | str:
    return dict(values) if values else ""


def add_training(commands) -> None:
    prepare = commands.add_parser("prepare", help="raw label files to the prepared training table")
    prepare.add_argument("tables", nargs="+", type=named, metavar="DATASET=FILE")
    prepare.add_argument("--denied", help="file whose first column lists ids to leave out")
    prepare.add_argument("--seed", type=int, default=47)
    prepare.add_argument("--out", default="train")

    for name, trees, what in (
        ("train-meta", training.META_TREES, "encoded columns"),
        ("train-coefficients", training.COEFFICIENT_TREES, "image coefficients and encoded columns"),
    ):
        train = commands.add_parser(name, help=f"trees on {what}: one fold, or all, saved under fold, fold count and AUC")
        train.add_argument("train")
        train.add_argument("test")
        train.add_argument("root", help="folder of the experiment")
        train.add_argument("--fold", type=int, help="one fold; without it, all")
        train.add_argument("--folds", type=int, default=4)
        train.add_argument("--trees", type=int, default=trees)
        train.add_argument("--patience", type=int, default=64)
        train.add_argument("--auc-every", type=int, default=1)
        train.add_argument("--sanity-check", action="store_true")
        if name == "train-coefficients":
            train.add_argument("--images", nargs="+", type=named, required=True, metavar="DATASET=FOLDER")
            train.add_argument("--glob", default="*.jpg")
            train.add_argument("--coefficients", type=int, default=8)

    index = commands.add_parser("index", help="list an experiment's fold models in its index")
    index.add_argument("root")
    index.add_argument("model_type")
    index.add_argument("--image-size", type=int, default=0)
    index.add_argument("--files", help="pattern of model files; without it, saved tree models")

    test = commands.add_parser("score-test", help="scores of the test rows by every fold model")
    validation = commands.add_parser("score-validation", help="scores of the training rows by the model that did not see them")
    for command in (test, validation):
        command.add_argument("root")
        command.add_argument("train")
        command.add_argument("test")
        command.add_argument("--out", default=".")
    test.add_argument("--template", required=True, help="submission template; its ids give the rows")


def run_training(spark, args) -> None:
    if args.command == "prepare":
        studies.prepare_files(spark, dict(args.tables), args.out, args.denied, seed=args.seed)
    elif args.command == "index":
        if args.files:
            print(experiment.index_model_files(spark, args.root, args.model_type, args.image_size, args.files))
        else:
            print(experiment.index_experiment(spark, args.root, args.model_type, args.image_size))
    elif args.command == "score-test":
        _, test = load_sample_sets(spark, args.train, args.test)
        print(experiment.score_test(spark, args.root, test.df, read_submission(spark, args.template), args.out))
    elif args.command == "score-validation":
        train, _ = load_sample_sets(spark, args.train, args.test)
        print(experiment.score_validation(spark, args.root, train.df, args.out))
    else:
        on_images = args.command == "train-coefficients"
        where = roots(args.images) if on_images else ""
        train, _ = load_sample_sets(spark, args.train, args.test, where, sanity_check=args.sanity_check)
        params = BoostParams(max_trees=args.trees, patience=args.patience, auc_every=args.auc_every)
        images = read_images(spark, where, args.glob) if on_images else None
        for fold in range(args.folds) if args.fold is None else (args.fold,):
            if on_images:
                path, fitted = training.train_fold_on_coefficients(train, images, fold, args.folds, args.root, args.coefficients, params=params)
            else:
                path, fitted = training.train_fold_on_meta(train, fold, args.folds, args.root, params=params)
            print(f"{path}: {fitted.n_trees} trees, auc {fitted.auc}")


TRAINING = ("prepare", "train-meta", "train-coefficients", "index", "score-test", "score-validation")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="foldmark")
    commands = top.add_subparsers(dest="command", required=True)

    add_training(commands)

    survey = commands.add_parser("survey", help="describe, largest scores and lowest mean ranks of several models")
    survey.add_argument("predictions", nargs="+", type=named, metavar="MODEL=FILE")
    survey.add_argument("--factor", nargs="*", type=named, default=[], metavar="MODEL=NUMBER", help="scale a model's scores")
    survey.add_argument("--column", help="model of the largest scores; the last one by default")
    survey.add_argument("--largest", type=int, default=30)
    survey.add_argument("--lowest", type=int, default=128)

    roc = commands.add_parser("roc", help="points of the ROC curve of one prediction file")
    roc.add_argument("labels")
    roc.add_argument("predictions")
    roc.add_argument("--all-points", action="store_true", help="also those at which the curve does not bend")

    for command in (survey, roc):
        command.add_argument("--out", required=True)

    measure = commands.add_parser("measure", help="AUC of one prediction file")
    measure.add_argument("labels")
    measure.add_argument("predictions")

    validate = commands.add_parser("validate", help="combine validation predictions, measure, write")
    validate.add_argument("rule", help="mean, power, rank or consensus")
    validate.add_argument("labels")
    validate.add_argument("predictions", nargs="+")
    validate.add_argument("--base", help="base predictions of the consensus rule")
    validate.add_argument("--exponent", type=float, default=2.0, help="exponent of the power rule")
    validate.add_argument("--out", default=".")

    average = commands.add_parser("average", help="mean of submissions")
    average.add_argument("predictions", nargs="+")

    folds = commands.add_parser("average-folds", help="mean of a wide file's fold columns")
    folds.add_argument("predictions")
    folds.add_argument("--folds", type=int, default=4)

    blend = commands.add_parser("blend", help="weighted blend of two submissions")
    blend.add_argument("first")
    blend.add_argument("second")
    blend.add_argument("weight", type=float, help="weight of the second")

    consensus = commands.add_parser("consensus", help="consensus of submissions around a base")
    consensus.add_argument("base")
    consensus.add_argument("predictions", nargs="+")

    for command, (above, below) in ((validate, VALIDATION_CUTOFFS), (consensus, SUBMISSION_CUTOFFS)):
        command.add_argument("--above", type=float, default=above, help="score that all must exceed")
        command.add_argument("--below", type=float, default=below, help="score that all must stay under")

    for command in (average, folds, blend, consensus):
        command.add_argument("--out", default="submission")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session("foldmark")
    if args.command in TRAINING:
        run_training(spark, args)
    elif args.command == "survey":
        factors = {name: float(value) for name, value in args.factor}
        studies.survey_predictions(spark, dict(args.predictions), args.out, factors, args.column, args.largest, args.lowest)
    elif args.command == "roc":
        studies.write_roc_curve(spark, args.labels, args.predictions, args.out, not args.all_points)
    elif args.command == "measure":
        print(f"auc: {studies.measure(spark, args.labels, args.predictions)}")
    elif args.command == "validate":
        cutoffs = (args.above, args.below)
        print(
            studies.validate_ensemble(
                spark, args.labels, args.predictions, args.rule, args.out, args.base, cutoffs, args.exponent
            )
        )
    elif args.command == "average":
        studies.average_submissions(spark, args.predictions, args.out)
    elif args.command == "average-folds":
        studies.average_folds(spark, args.predictions, args.out, args.folds)
    elif args.command == "blend":
        studies.blend_submissions(spark, args.first, args.second, args.weight, args.out)
    else:
        studies.consensus_submission(spark, args.base, args.predictions, args.out, (args.above, args.below))


if __name__ == "__main__":
    main()
