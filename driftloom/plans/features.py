"""The feature builder: raw records to a fixed list of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import nan_to_null
from driftloom.functions.joins import lookup_join, row_bound
from driftloom.operators import bins, encode, fold_fits, knn, missing, parse
from driftloom.operators.folds import stratified_folds
from driftloom.plans.persist import ComposedModel
from driftloom.session import durable
from driftloom.specs import (
    DEFAULT_PRIOR,
    ENCODED_INPUTS,
    ENCODER_FOLDS,
    ENCODER_M,
    NEIGHBOUR_INPUTS,
    NUMERIC_OUTPUTS,
    ONE_HOT_INPUTS,
)

SEED, INNER_SEED = 42, 43


def parsed(df: DataFrame) -> DataFrame:
    """Everything a row tells by itself."""
    return df.withColumns({"Age": nan_to_null("Age"), "Fare": nan_to_null("Fare")}).withColumns(
        {
            "Title": parse.group_rare(parse.courtesy_title("Name")),
            "FamilySize": parse.family_size("SibSp", "Parch"),
            "HasCabin": F.col("Cabin").isNotNull().cast("int"),
            "CabinDeck": parse.first_letter("Cabin"),
            "TicketPrefix": parse.code_prefix("Ticket"),
        }
    ).withColumn("IsAlone", parse.flag(F.col("FamilySize") == 1))


def derived(df: DataFrame, quartiles: Sequence[float]) -> DataFrame:
    """Ratios, bins and interactions, once the gaps are filled."""
    return df.withColumns(
        {
            "FarePerPerson": parse.rounded_ratio("Fare", "FamilySize"),
            "AgeBin": bins.age_bin("Age"),
            "FareBin": bins.quantile_bin("Fare", quartiles),
            "Pclass_Sex_Interaction": parse.interaction("Pclass", F.col("Sex") == "female"),
            "FamilyBin": bins.family_bin("FamilySize"),
        }
    )


class FeatureBuilderModel(ComposedModel):
    """state: id_col, label, mode, quartiles, prior, categories, wide, columns, age_flag, k. tables: of knn.fit, tickets, fares, encodings, and
    index_<c> of each column c in wide: those with too many categories for a column each, which become a sparse vector."""

    @property
    def columns(self) -> list[str]:
        return self.state["columns"]

    def known(self, table: str) -> int:
        """Rows of a fitted table, counted once; tables above the broadcast limit are joined by shuffle."""
        sizes = self.state.setdefault("sizes", {})
        if table not in sizes:
            sizes[table] = row_bound(self.tables[table])
        return sizes[table]

    def prepare(self, df: DataFrame, fill_fare: bool = True, labelled: bool = False) -> DataFrame:
        """All features but the encodings and flags. `labelled` carries the label along as __label, on its own row."""
        s = self.state
        id_col = s["id_col"]
        if labelled:
            df = df.withColumn("__label", F.col(s["label"]).cast("int"))
        rows = parsed(encode.drop_label(df, s["label"]) if s["label"] else df)
        rows = rows.withColumn("Embarked", F.coalesce("Embarked", F.lit(s["mode"])))
        if fill_fare:
            rows = missing.fill_group_median(rows, self.tables["fares"], "Pclass", "Fare", self.known("fares"))
        rows = rows.withColumn("Age_is_na", F.col("Age").isNull().cast("int"))
        rows = knn.fill(rows, self.tables, NEIGHBOUR_INPUTS, id_col, s["k"], targets=["Age"])
        rows = derived(rows, s["quartiles"])
        return encode.frequency_encode(
            rows, self.tables["tickets"], "Ticket", "TicketFrequency", spread_by=[id_col], known_rows=self.known("tickets")
        )

    def finish(self, encoded: DataFrame, keep: Sequence[str]) -> DataFrame:
        flags = encode.one_hot(encoded, self.state["categories"])
        for c in self.state.get("wide", []):
            flags = encode.sparse_flags(flags, self.tables[f"index_{c}"], c, self.models[f"flags_{c}"], known_rows=self.known(f"index_{c}"))
        return encode.align(flags, self.columns, keep)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.finish(self.encoded(self.prepare(df)), [self.state["id_col"]])

    def encoded(self, rows: DataFrame) -> DataFrame:
        """Prepared rows with the fitted encodings."""
        s = self.state
        if "encodings" in self.tables:
            return encode.apply_target_encoding(
                rows, self.tables["encodings"], ENCODED_INPUTS, s["prior"], spread_by=[s["id_col"]], known_rows=self.known("encodings")
            )
        return rows.withColumns({f"{c}_TE": F.lit(s["prior"]) for c in ENCODED_INPUTS})


class FeatureBuilder(Estimator):
    """Fits modes, medians, quartiles, ticket counts, donors, encodings and category lists from labelled records.

    Without a label column the encodings are the constant default prior.
    """

    def __init__(
        self,
        id_col: str = "PassengerId",
        label: str | None = "Survived",
        m: float = ENCODER_M,
        folds: int = ENCODER_FOLDS,
        default_prior: float = DEFAULT_PRIOR,
        k: int = 5,
        most_flags: int = 10_000,
    ):
        """most_flags: categories of a column that get a column each; a wider one becomes one sparse vector, <c>_flags."""
        super().__init__()
        self.id_col, self.label, self.m, self.folds = id_col, label, m, folds
        self.default_prior, self.k, self.most_flags = default_prior, k, most_flags

    def _fit(self, df: DataFrame) -> FeatureBuilderModel:
        return self._fitted(df)[0]

    def _fitted(self, df: DataFrame) -> tuple[FeatureBuilderModel, DataFrame]:
        label = self.label if self.label and self.label in df.columns else None
        base = parsed(df)
        mode = missing.modes(base, ["Embarked"])["Embarked"] or "S"
        fares = durable(missing.group_medians(base, "Pclass", "Fare"))
        donors = base.select(self.id_col, *[F.col(c).cast("double").alias(c) for c in NEIGHBOUR_INPUTS])
        neighbours = knn.fit(donors, NEIGHBOUR_INPUTS, self.id_col, self.k, ["Age"])
        tickets = durable(encode.key_counts(base, "Ticket"))
        quartiles = bins.quartiles(base, "Fare")
        state = {
            "id_col": self.id_col,
            "label": label,
            "mode": mode,
            "quartiles": quartiles,
            "prior": self.default_prior,
            "k": self.k,
        }
        gaps = missing.columns_with_missing(base, ["Age", "Fare"])
        state["age_flag"], state["fare_gaps"] = "Age" in gaps, "Fare" in gaps
        model = FeatureBuilderModel(state, {"fares": fares, "tickets": tickets, **neighbours})
        # as at fit time: fares keep their gaps, only ages are filled
        rows = durable(model.prepare(df, fill_fare=False, labelled=label is not None))
        if label:
            model.tables["encodings"] = durable(encode.target_encoding(rows, ENCODED_INPUTS, "__label", self.m))
            state["prior"] = rows.agg(F.avg(F.col("__label").cast("double"))).first()[0]
        state["categories"] = encode.freeze_categories(rows, ONE_HOT_INPUTS, self.most_flags)
        state["wide"] = [c for c in ONE_HOT_INPUTS if c not in state["categories"]]
        numeric = [*NUMERIC_OUTPUTS, *(["Age_is_na"] if state["age_flag"] else [])]
        flags = [f"{c}_{v}" for c in ONE_HOT_INPUTS for v in state["categories"].get(c, [])[1:]]
        for c in state["wide"]:
            model.tables[f"index_{c}"] = index = durable(encode.category_index(rows, c))
            model.models[f"flags_{c}"] = encode.flag_encoder(c, index.count())
        state["columns"] = [*numeric, *flags, *[f"{c}_flags" for c in state["wide"]]]
        return model, rows

    def fit_transform(self, df: DataFrame, leaky: bool = False) -> tuple[FeatureBuilderModel, DataFrame]:
        """(model, training features with id and label).

        Training rows get out-of-fold encodings, so their own label does not reach their features.
        leaky=True gives them the full-data encodings instead, as a plain fit and transform would. The label stays on
        its row: repeated or missing ids neither multiply nor lose rows.
        """
        model, rows = self._fitted(df)
        label = model.state["label"]
        if not label:
            return model, model.transform(df)
        folds = encode.effective_folds(rows, "__label", self.folds)
        if leaky or folds < 2:
            whole = model.encoded(model.prepare(df, labelled=True)).withColumn(label, F.col("__label"))
            return model, model.finish(whole, [self.id_col, label])
        if model.state["fare_gaps"]:
            # a filled fare changes distances and bins, so these rows are prepared as in transform
            rows = model.prepare(df, labelled=True)
        split = durable(stratified_folds(rows, "__label", self.id_col, folds, SEED, "__fold"))
        table = durable(encode.fold_encoding(split, ENCODED_INPUTS, "__label", "__fold", self.m))
        encoded = encode.apply_fold_encoding(
            split, table, ENCODED_INPUTS, "__fold", spread_by=[self.id_col], known_rows=row_bound(table)
        )
        encoded = encoded.withColumn(label, F.col("__label"))
        return model, model.finish(encoded, [self.id_col, label])


    def fold_features(self, df: DataFrame, fold: str, folds: int) -> tuple[list[str], DataFrame]:
        """(columns, rows) for out-of-fold training: everything is fitted without the fold that is held out.

        rows: (id, label, fold, fit, held, columns...), each record once per left-out fold `fit`. held: it is the fold's own row,
        with what the other folds tell (as a new record would get it); else a training row of that fit, with encodings that leave out its
        own fold too (of two folds, its own part of the fold: encoding_parts). Statistics come from one count per value and fold (operators.fold_fits), so there is no pass per fold.
        Flags of a category that the other folds don't have are 0 in all training rows of that fit, so no model can use them.
        """
        if not (self.label and self.label in df.columns):
            raise ValueError("folds need a label")
        id_col, number = self.id_col, F.col(fold).cast("int")
        base = durable(parsed(df.withColumn("__label", F.col(self.label).cast("int")).drop(self.label)).withColumn(fold, number))
        grid = F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))
        # one row per fold each
        modes = {r["fit"]: r["mode"] for r in fold_fits.leave_out_modes(base, ["Embarked"], fold, folds).collect()}
        quartiles = {
            r["fit"]: list(r["quantiles"])
            for r in fold_fits.leave_out_percentiles(base, ["Fare"], [0.25, 0.5, 0.75], fold, folds).collect()
        }
        medians = fold_fits.leave_out_percentiles(base, ["Fare"], [0.5], fold, folds, by=["Pclass"])
        medians = durable(medians.select("fit", "Pclass", "n", F.col("quantiles")[0].alias("median")))
        tickets = durable(fold_fits.leave_out_frequencies(base, "Ticket", fold, folds))
        port = F.coalesce("Embarked", *[F.when(F.col("fit") == f, F.lit(modes.get(f, "S"))) for f in range(folds)])
        rows = base.drop("Name", "Cabin").withColumn("fit", grid).withColumn("Embarked", port)
        rows = lookup_join(rows, medians, ["fit", "Pclass"], "n", ["median"], known_rows=row_bound(medians))
        rows = rows.withColumn("Fare", F.coalesce("Fare", "median")).drop("median").withColumn("Age_is_na", F.col("Age").isNull().cast("int"))
        donors = base.select(id_col, fold, *[F.col(c).cast("double").alias(c) for c in NEIGHBOUR_INPUTS])
        donors = donors.withColumn("fit", grid).where(F.col("fit") != F.col(fold))
        rows = knn.knn_fill(rows, donors, NEIGHBOUR_INPUTS, id_col, self.k, targets=["Age"], by="fit")
        cut = [F.when(F.col("fit") == f, bins.quantile_bin("Fare", quartiles.get(f, []))) for f in range(folds)]
        rows = derived(rows, []).withColumn("FareBin", F.coalesce(*cut))
        rows = lookup_join(rows, tickets, ["fit", "Ticket"], "n", ["n"], [id_col], row_bound(tickets))
        rows = durable(rows.withColumn("TicketFrequency", F.coalesce("n", F.lit(1)).cast("long")).drop("n", "Ticket"))
        rows, part, parts = self.encoding_parts(base, rows, fold, folds)
        table = durable(fold_fits.nested_encodings(rows, ENCODED_INPUTS, "__label", part, "fit", parts, self.m))
        if part != "fold":
            table = table.withColumnRenamed("fold", part)
        if parts == folds + 1:  # nothing to leave out: as held-out rows, encoded by all training rows
            rows = rows.withColumn(part, F.col("fit"))
        encoded = encode.apply_fold_encoding(
            rows, table, ENCODED_INPUTS, part, spread_by=[id_col], known_rows=row_bound(table), also=["fit"]
        )
        categories = encode.freeze_categories(rows, ONE_HOT_INPUTS, self.most_flags)
        wide = [c for c in ONE_HOT_INPUTS if c not in categories]
        gaps = missing.columns_with_missing(base, ["Age"])
        columns = [*NUMERIC_OUTPUTS, *(["Age_is_na"] if gaps else []), *[f"{c}_{v}" for c in ONE_HOT_INPUTS for v in categories.get(c, [])[1:]]]
        columns += [f"{c}_flags" for c in wide]
        encoded = encoded.withColumn(self.label, F.col("__label")).withColumn("held", F.col("fit") == F.col(fold))
        flags = encode.one_hot(encoded, categories)
        for c in wide:
            index = durable(encode.category_index(rows, c))
            flags = encode.sparse_flags(flags, index, c, encode.flag_encoder(c, index.count()), known_rows=row_bound(index))
        return columns, encode.align(flags, columns, [id_col, self.label, fold, "fit", "held"])

    def encoding_parts(self, base: DataFrame, rows: DataFrame, fold: str, folds: int) -> tuple[DataFrame, str, int]:
        """(rows, column, number of parts): training rows are encoded without the rows of their part.

        The parts are the folds. With two folds nothing is left outside a fit and a training row's own fold; so these rows get
        parts of their own, numbered after the folds, as many as the encoder has folds and the smallest class of a fold allows.
        """
        sizes = base.where(F.col(fold).isNotNull()).groupBy(fold, "__label").agg(F.count(F.lit(1)).alias("n")).collect()
        if len({r[fold] for r in sizes}) > 2:
            return rows, fold, folds
        classes = len({r["__label"] for r in sizes})
        whole = all(sum(r[fold] == f for r in sizes) == classes for f in {r[fold] for r in sizes})
        inner = max(1, min(self.folds, *[r["n"] for r in sizes])) if sizes and classes > 1 and whole else 1
        # by another hash than the folds, whose ranks would share their remainders with these
        rows = rows.withColumn("__stratum", F.struct("fit", fold, "__label"))
        rows = stratified_folds(rows, "__stratum", self.id_col, inner, INNER_SEED, "__part").drop("__stratum")
        part = F.when(F.col("fit") == F.col(fold), F.col("fit")).when(F.col(fold).isNotNull(), folds + F.col("__part"))
        return durable(rows.withColumn("__part", part.cast("int"))), "__part", folds + inner


class ColumnSelector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the named columns that are there and assembles them into a vector."""

    columns = Param(Params._dummy(), "columns", "names in order", typeConverter=TypeConverters.toListString)
    keep = Param(Params._dummy(), "keep", "other columns to carry along", typeConverter=TypeConverters.toListString)

    def __init__(self, columns: Sequence[str] | None = None, keep: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(columns=[], keep=[])
        if columns is not None:
            self._set(columns=list(columns))
        if keep is not None:
            self._set(keep=list(keep))

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [c for c in self.getOrDefault(self.columns) if c in df.columns]
        kept = [c for c in self.getOrDefault(self.keep) if c in df.columns]
        vectors = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
        return vectors.transform(df).select(*kept, *names, "features")
